from fractions import Fraction as Fr

import pytest

from tesserae.operators.units import EDGES, UnitGraph, common_units, number, read_answer, read_table

SCHEMA = "sample_id bigint, df_md string, metadata struct<caption: string>, question string, final_answer_sql string"


@pytest.mark.parametrize(
    ("text", "want"),
    [("4.397", (4397, 0)), ("0.606", (606, 3)), ("0,204", (204, 3)), ("-0.754", (-754, 3)), ("215.731,87", (21573187, 2)), ("1,217.5", (12175, 1)), ("71 478", (71478, 0)), ("8 184.12", (818412, 2)), ("−7.99", (-799, 2)), ("12", (12, 0))],
)
def test_numbers(text, want):
    assert number(text) == want


def test_cycles_agree_and_a_wrong_edge_is_found():
    UnitGraph().check()
    with pytest.raises(ValueError):
        UnitGraph([*EDGES, ("mi", "m", "1609", "0")]).check()


def test_factors():
    c = UnitGraph().to_canonical()
    assert c["mi"][1:] == (Fr("160934.4"), 0)
    assert c["ac"][1] == Fr("4046.8564224")
    assert c["short ton"][1] == Fr("907184.74")
    assert c["kn"][1] == 1852 and c["degF"][1:] == (Fr(5000, 9), Fr(-160000, 9))


def test_units_from_cell_header_caption_question():
    md = "| Name | Height [ft] | Load | Votes | Works |\n|---|---|---|---|---|\n| A | 12 | 3 t (6,614 lb) | 12,006 | ~5 [1] |\n| B | 900 cm | n/a | 3 | 2 h 05 min |\n| C | 5′ 4″ | 2 | 7 | ? |"
    got = {(i, j): v for i, j, v in read_table(md, "Sites of X. Load given in kg", "Which? State the works in days.")}
    assert got[0, 1] == (12, 0, 0, "ft") and got[1, 1] == (900, 0, 0, "cm") and got[2, 1] == (64, 0, 0, "in")
    assert got[0, 2] == (3, 0, 0, "t") and got[2, 2] == (2, 0, 0, "kg") and (1, 2) not in got
    assert got[0, 4] == (5, 0, 0, "d") and got[1, 4] == (125, 0, 0, "min")
    assert not any(j == 3 for _, j in got)


def test_answers():
    assert read_answer("X comes to 12.57 metres in the register.", None) == (1257, 2, 0, "m")
    assert read_answer("871.5", "Which? State the height in feet.") == (8715, 1, 0, "ft")
    assert read_answer("3784", "Which one?") is None
    assert read_answer("| A | 1 m |", None) is None and read_answer(None, None) is None


def test_spark_rounding_nulls_and_extra_columns(spark):
    rows = [
        (1, "| H (°F) | seq |\n|---|---|\n| 31.18 | 1 |\n| -40 | 2 |\n|  | 3 |", (None,), None, "1.5 min"),
        (2, None, None, None, None),
        (3, "", ("c",), "q", ""),
        (1, "| H (°F) | seq |\n|---|---|\n| 31.18 | 1 |", (None,), None, None),
        (4, "| H, inches |\n|---|\n| " + "1" * 40 + " |", None, None, "0.005 cm"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS unit", "1 AS digits", "2 AS base_value")
    got = sorted(map(tuple, common_units(df).collect()))
    assert (1, 0, 0, -456) in got and (1, 1, 0, -40000) in got and (1, -1, -1, 90) in got
    assert got.count((1, 0, 0, -456)) == 2
    assert (4, -1, -1, 0) in got and not any(r[0] in (2, 3) for r in got)
    assert common_units(df.limit(0)).count() == 0
