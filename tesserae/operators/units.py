"""Quantities recorded in different units: conversions as a graph of affine edges, composed once and joined by unit.

Edges hold exact rationals. From every unit the shortest composition to its dimension's canonical unit is precomputed,
every further edge is checked against the compositions it closes a cycle with, and the result is a small conversion
table of fixed size. Values are read from cells and answers (number, scale, unit, the unit often told only by header,
caption or question) and converted by an equi-join on the source unit, in exact decimal arithmetic.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from fractions import Fraction as Fr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.session import spread

# Canonical unit of each dimension.
CANONICAL = {"length": "cm", "area": "m2", "mass": "g", "time": "s", "speed": "m/h", "volume": "L", "temperature": "mdegC"}
# Names of units as sources write them.
NAMES = {
    "mm": "mm millimetre millimetres millimeter millimeters millimètre millimètres",
    "cm": "cm centimetre centimetres centimeter centimeters centimètre centimètres Zentimeter centímetros",
    "m": "m metre metres meter meters mètre mètres metro metros",
    "km": "km kilometre kilometres kilometer kilometers kilomètre kilomètres kilómetros",
    "in": "in in. inch inches ″ \"",
    "ft": "ft ft. foot feet ′ '",
    "yd": "yd yd. yds yard yards",
    "mi": "mi mi. mile miles",
    "nmi": "nmi NM nautical_mile nautical_miles naut._mi",
    "m2": "m2 m² sq_m square_metre square_metres square_meter square_meters mètres_carrés Quadratmeter",
    "km2": "km2 km² sq_km square_kilometre square_kilometres square_kilometer square_kilometers",
    "ha": "ha hectare hectares Hektar hectáreas",
    "ac": "ac acre acres",
    "sq mi": "sq_mi square_mile square_miles mi2 mi²",
    "sq ft": "sq_ft square_foot square_feet ft2 ft²",
    "sq yd": "sq_yd square_yard square_yards yd2 yd²",
    "mg": "mg milligram milligrams",
    "g": "g gram grams gramme grammes",
    "kg": "kg kgs kilogram kilograms kilogramme kilogrammes Kilogramm",
    "t": "t tonne tonnes metric_ton metric_tons metric_tonne metric_tonnes Tonnen toneladas",
    "lb": "lb lb. lbs lbs. pound pounds",
    "oz": "oz ounce ounces",
    "short ton": "short_ton short_tons US_ton US_tons U.S._ton U.S._tons",
    "long ton": "long_ton long_tons imperial_ton imperial_tons",
    "s": "s sec sec. secs second seconds Sekunden secondes segundos",
    "min": "min min. mins minute minutes Minuten minutos",
    "h": "h hr hrs hr. hrs. hour hours Stunden heures horas",
    "d": "d day days Tage jours días",
    "wk": "wk week weeks",
    "m/s": "m/s metres_per_second meters_per_second m_per_s",
    "km/h": "km/h kph kmh kilometres_per_hour kilometers_per_hour",
    "mph": "mph miles_per_hour mi/h",
    "kn": "kn kt kts knot knots",
    "ft/s": "ft/s feet_per_second",
    "mL": "mL ml millilitre millilitres milliliter milliliters",
    "L": "L l litre litres liter liters Litern",
    "hL": "hL hl hectolitre hectolitres hectoliter hectoliters",
    "m3": "m3 m³ cubic_metre cubic_metres cubic_meter cubic_meters cu_m",
    "US gal": "US_gal US_gal. US_gallon US_gallons U.S._gallon U.S._gallons",
    "imp gal": "imp_gal imp._gal imp_gal. imperial_gallon imperial_gallons",
    "cu ft": "cu_ft cubic_foot cubic_feet ft3 ft³",
    "degC": "°C ℃ deg_C degree_Celsius degrees_Celsius degC",
    "degF": "°F ℉ deg_F degree_Fahrenheit degrees_Fahrenheit degF",
    "K": "K kelvin kelvins Kelvin",
}
# Edges (from, to, factor, offset): to = factor * from + offset. Some close cycles; they are checked.
EDGES = [
    ("mm", "cm", "1/10", "0"), ("m", "cm", "100", "0"), ("km", "m", "1000", "0"), ("in", "cm", "127/50", "0"), ("ft", "in", "12", "0"), ("yd", "ft", "3", "0"), ("mi", "yd", "1760", "0"), ("nmi", "m", "1852", "0"), ("mi", "km", "201168/125000", "0"), ("ft", "m", "381/1250", "0"), ("yd", "m", "1143/1250", "0"),
    ("km2", "m2", "1000000", "0"), ("ha", "m2", "10000", "0"), ("km2", "ha", "100", "0"), ("ac", "sq yd", "4840", "0"), ("sq mi", "ac", "640", "0"), ("sq yd", "sq ft", "9", "0"), ("sq ft", "m2", "145161/1562500", "0"), ("ac", "m2", "40468564224/10000000", "0"),
    ("mg", "g", "1/1000", "0"), ("kg", "g", "1000", "0"), ("t", "kg", "1000", "0"), ("lb", "g", "45359237/100000", "0"), ("lb", "oz", "16", "0"), ("short ton", "lb", "2000", "0"), ("long ton", "lb", "2240", "0"), ("lb", "kg", "45359237/100000000", "0"),
    ("min", "s", "60", "0"), ("h", "min", "60", "0"), ("d", "h", "24", "0"), ("wk", "d", "7", "0"), ("h", "s", "3600", "0"),
    ("km/h", "m/h", "1000", "0"), ("m/s", "m/h", "3600", "0"), ("m/s", "km/h", "18/5", "0"), ("mph", "m/h", "201168/125", "0"), ("kn", "m/h", "1852", "0"), ("ft/s", "m/s", "381/1250", "0"),
    ("mL", "L", "1/1000", "0"), ("hL", "L", "100", "0"), ("m3", "L", "1000", "0"), ("US gal", "L", "473176473/125000000", "0"), ("imp gal", "L", "454609/100000", "0"), ("cu ft", "L", "1769802912/62500000", "0"),
    ("degC", "mdegC", "1000", "0"), ("degF", "degC", "5/9", "-160/9"), ("K", "degC", "1", "-5463/20"), ("degF", "K", "5/9", "45967/180"),
]


class UnitGraph:
    """Units as nodes, affine conversions as edges in both directions."""

    def __init__(self, edges: list[tuple[str, str, str, str]] = EDGES) -> None:
        self.out: dict[str, list[tuple[str, Fr, Fr]]] = {}
        for a, b, f, o in edges:
            k, c = Fr(f), Fr(o)
            self.out.setdefault(a, []).append((b, k, c))
            self.out.setdefault(b, []).append((a, 1 / k, -c / k))

    def compositions(self, start: str) -> dict[str, tuple[Fr, Fr]]:
        """unit -> (factor, offset) from start along a shortest path."""
        seen = {start: (Fr(1), Fr(0))}
        queue = deque([start])
        while queue:
            u = queue.popleft()
            f, o = seen[u]
            for v, k, c in self.out.get(u, []):
                if v not in seen:
                    seen[v] = (k * f, k * o + c)
                    queue.append(v)
        return seen

    def check(self) -> None:
        """Every edge must agree with the shortest compositions around each cycle it closes."""
        for start in self.out:
            seen = self.compositions(start)
            for u, (f, o) in seen.items():
                for v, k, c in self.out[u]:
                    if seen[v] != (k * f, k * o + c):
                        raise ValueError(f"conversions from {start} to {v} disagree by way of {u}")

    def to_canonical(self) -> dict[str, tuple[str, Fr, Fr]]:
        """unit -> (canonical unit, factor, offset)."""
        out = {}
        for target in CANONICAL.values():
            for u, (f, o) in self.compositions(target).items():
                out[u] = (target, 1 / f, -o / f)
        return out


def conversion_table(spark: SparkSession, graph: UnitGraph | None = None) -> DataFrame:
    """(unit, canonical, num, off, den): canonical = (num * value + off) / den, integers. One row per unit."""
    graph = graph or UnitGraph()
    graph.check()
    rows = []
    for u, (target, f, o) in sorted(graph.to_canonical().items()):
        den = f.denominator * o.denominator
        rows.append((u, target, str(f.numerator * o.denominator), str(o.numerator * f.denominator), str(den)))
    df = spark.createDataFrame(rows, "unit string, canonical string, num string, off string, den string")
    return df.select("unit", "canonical", *(F.col(c).cast("decimal(20,0)").alias(c) for c in ("num", "off", "den")))


def _flex(name: str) -> str:
    return r"[\s\u00a0\u202f]+".join(re.escape(p) for p in name.split("_"))


UNIT_OF = {n.replace("_", " "): u for u, names in NAMES.items() for n in names.split(" ")}
FOLDED = {}
for _n, _u in UNIT_OF.items():
    FOLDED.setdefault(_n.lower(), _u)
_NAMES = sorted((n for names in NAMES.values() for n in names.split(" ")), key=len, reverse=True)
UNIT = "(?:" + "|".join(map(_flex, _NAMES)) + r")(?![^\W_])"
GAP = r"[\s\u00a0\u202f]*"
SPACES = " \u00a0\u202f\u2009\u2007"
NUMBER = rf"[-−–+]?\d+(?:[.,{SPACES}'’]\d+)*"
SCALE = r"(?:10\^?3|10³|1000|1,000|'000|thousand|10\^?6|10⁶|million|1,000,000|billion)"
SCALES = {"10^3": 3, "103": 3, "10³": 3, "1000": 3, "1,000": 3, "'000": 3, "thousand": 3, "10^6": 6, "106": 6, "10⁶": 6, "million": 6, "1,000,000": 6, "billion": 9}
MARKS = r"(?:~|≈|±|<|>|≤|≥|c\.|ca\.|circa|approx\.|approximately|about|around|est\.|etwa|env\.|aprox\.|roughly)"
HEAD_UNIT = re.compile(rf"^(?P<q>.+?)(?:\s*[,:]\s*|\s+in\s+|\s+en\s+|\s*[(\[]\s*(?:in\s+)?)(?P<s>{SCALE}\s*(?:of\s+)?)?(?P<u>{UNIT})\s*[)\]]?\s*$", re.I)
CELL = re.compile(rf"^{GAP}(?:{MARKS}{GAP})*(?P<n>{NUMBER})(?:{GAP}(?P<s>{SCALE}))?(?:{GAP}(?P<u>{UNIT})(?:{GAP}(?P<n2>\d+(?:[.,]\d+)?){GAP}(?P<u2>{UNIT}|m)(?:{GAP}(?P<n3>\d+(?:[.,]\d+)?){GAP}(?P<u3>{UNIT}))?)?)?(?P<rest>{GAP}(?:[(\[*†‡§¹²³⁴⁵].*|\.|))$", re.I | re.S)
IN_TEXT = re.compile(rf"(?<![\w.,])(?P<n>{NUMBER})(?:{GAP}(?P<s>{SCALE}))?{GAP}(?P<u>{UNIT})(?:{GAP}(?P<n2>\d+(?:[.,]\d+)?){GAP}(?P<u2>{UNIT}|m)(?![^\W_]))?", re.I)
BARE_IN_TEXT = re.compile(rf"(?:comes to|gelten|on note|constan|is|ist|est|es|beträgt|:)\s+(?:{MARKS}{GAP})*(?P<n>{NUMBER})(?!\w|\s*[%/])")
BARE = re.compile(rf"^{GAP}(?:{MARKS}{GAP})*(?P<n>{NUMBER}){GAP}[.*†‡]?(?:{GAP}\[\w+\])?{GAP}$")
QUESTION_UNIT = re.compile(rf"(?:^|[\s\u00a0\u202f])(?:state|give|express|report|angabe|angeben|donnez|indiquez|indique|dé|answer|antwort)\b[^.?!]*?\s(?:in|en)\s+(?P<s>{SCALE}\s+)?(?P<u>{UNIT})\s*[.?!)\s]*$", re.I)
SEPARATORS = re.compile(rf"[.,{SPACES}'’]")
TAIL_DIGITS = re.compile(r"[.,]\d+$")


def number(text: str) -> tuple[int, int] | None:
    """(digits as an integer, decimals). A separator followed by exactly three digits groups thousands, unless only a 0
    stands before it; any other last comma or point is the decimal one."""
    sign = -1 if text[0] in "-−–" else 1
    t = text.lstrip("-−–+")
    parts = SEPARATORS.split(t)
    seps = SEPARATORS.findall(t)
    if not seps:
        return sign * int(t), 0
    last = parts[-1]
    groups = len(last) == 3 and not (len(parts) == 2 and parts[0].strip("0") == "" and seps[-1] in ".,")
    if groups or seps[-1] not in ".,":
        return sign * int("".join(parts)), 0
    return sign * int("".join(parts)), len(last)


def unit_of(name: str) -> str | None:
    n = re.sub(r"\s+", " ", name.strip())
    return UNIT_OF.get(n) or FOLDED.get(n.lower())


def scale_of(text: str | None) -> int:
    if not text:
        return 0
    return SCALES.get(re.sub(r"\s*(of)?\s*$", "", text.strip().lower()), 0)


GRAPH = UnitGraph()
RATIO: dict[tuple[str, str], Fr] = {}
for _a in NAMES:
    for _b, (_f, _o) in GRAPH.compositions(_a).items():
        if _o == 0:
            RATIO[_a, _b] = _f


def value_of(m: re.Match, unit: str | None, scale: int) -> tuple[int, int, int, str] | None:
    """(digits, decimals, power of ten, unit) of a matched quantity; feet and inches or hours and minutes are added up."""
    n = number(m["n"])
    if n is None:
        return None
    g = m.groupdict()
    own = unit_of(m["u"]) if g.get("u") else None
    u = own or unit
    if u is None:
        return None
    digits, decimals = n
    power = scale_of(m["s"]) if g.get("s") else (0 if own else scale)
    if g.get("n2"):
        u2 = "min" if g["u2"] == "m" and u in ("h", "d") else unit_of(g["u2"])
        k = RATIO.get((u, u2)) if u2 else None
        if k is not None and k.denominator == 1 and k > 1:
            d2, p2 = number(g["n2"])
            total = (abs(digits) * k.numerator) * 10**p2 + d2 * 10**decimals
            digits, decimals, u = (-total if digits < 0 else total), decimals + p2, u2
            if g.get("n3"):
                u3 = unit_of(g["u3"])
                k3 = RATIO.get((u, u3)) if u3 else None
                if k3 is not None and k3.denominator == 1 and k3 > 1:
                    d3, p3 = number(g["n3"])
                    digits, decimals, u = digits * k3.numerator * 10**p3 + d3 * 10**decimals, decimals + p3, u3
    return digits, decimals, power, u


def told(text: str | None, quantity: str) -> tuple[str, int] | None:
    """(unit, power of ten) that a caption or question gives for a quantity."""
    if not text:
        return None
    m = re.search(rf"\b{re.escape(quantity)}\b(?:\s+(?:figures|values|data))?(?:\s+(?:are|is|given|measured|stated|recorded|expressed|shown))*\s*(?:\(|\[|,|:|\bin\b|\ben\b)\s*(?:in\s+(?!the))?(?P<s>{SCALE}\s+)?(?P<u>{UNIT})", text, re.I)
    u = m and unit_of(m["u"])
    return (u, scale_of(m["s"])) if u else None


def read_table(md: str | None, caption: str | None, question: str | None) -> Iterator[tuple[int, int, tuple[int, int, int, str]]]:
    """(body row, column, value) of every measured cell of a markdown table."""
    if not md:
        return
    lines = [x for x in md.split("\n") if x.strip()]
    if not lines:
        return
    rows = [[c.strip() for c in x.strip().removeprefix("|").removesuffix("|").split("|")] for x in lines]
    body = rows[1:]
    if body and all(re.fullmatch(r":?-+:?", c) for c in body[0]):
        body = body[1:]
    for j, head in enumerate(rows[0]):
        m = HEAD_UNIT.match(head)
        base: tuple[str, int] | None = None
        if m and unit_of(m["u"]):
            base = unit_of(m["u"]), scale_of(m["s"])
        elif head:
            base = told(caption, head) or told(question, head)
        for i, row in enumerate(body):
            if j >= len(row) or not any(ch.isdigit() for ch in row[j]):
                continue
            c = CELL.match(row[j])
            if not c:
                continue
            v = value_of(c, base[0] if base else None, base[1] if base else 0)
            if v:
                yield i, j, v


def read_answer(answer: str | None, question: str | None) -> tuple[int, int, int, str] | None:
    """The first measured value that an answer states; its unit may stand only in the question. Tables and lists state none."""
    if not answer or answer.lstrip().startswith(("|", "[", "{")):
        return None
    for m in IN_TEXT.finditer(answer):
        if m["u"].lower() == "in" and re.match(r"\s+(?:the|a|an|this|that|\d{4})\b", answer[m.end("u") :]):
            continue
        v = value_of(m, None, 0)
        if v:
            return v
    q = QUESTION_UNIT.search(question or "")
    u = q and unit_of(q["u"])
    if u:
        m = BARE.match(answer) or BARE_IN_TEXT.search(answer)
        if m:
            return value_of(m, u, scale_of(q["s"]))
    return None


def measured_values(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, row_idx, col_idx, digits, decimals, power, unit): every measured cell, and the answer at -1, -1."""
    kind = dict(samples.dtypes)[key]
    slim = samples.select(F.col(key), "df_md", F.col("metadata.caption").alias("caption"), "question", "final_answer_sql")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, md, cap, q, a in zip(*(b[c].tolist() for c in (key, "df_md", "caption", "question", "final_answer_sql")), strict=True):
                out += [(k, i, j, str(v[0]), v[1], v[2], v[3]) for i, j, v in read_table(md, cap, q)]
                v = read_answer(a, q)
                if v:
                    out.append((k, -1, -1, str(v[0]), v[1], v[2], v[3]))
            yield pd.DataFrame(out, columns=[key, "row_idx", "col_idx", "digits", "decimals", "power", "unit"])

    return spread(slim).mapInPandas(read, f"{key} {kind}, row_idx int, col_idx int, digits string, decimals int, power int, unit string")


def to_base(values: DataFrame) -> DataFrame:
    """Adds canonical and base_value: the exact conversion rounded to the nearest integer, halves away from zero."""
    conv = conversion_table(values.sparkSession)
    j = values.join(F.broadcast(conv), "unit")  # one row per known unit: of fixed size
    ten = lambda p: F.pow(F.lit(10.0), p).cast("decimal(12,0)")
    up = ten(F.greatest(F.col("power") - F.col("decimals"), F.lit(0)))
    down = ten(F.greatest(F.col("decimals") - F.col("power"), F.lit(0)))
    v = (F.col("digits").try_cast("decimal(18,0)") * up).try_cast("decimal(20,0)")
    top = (v * F.col("num").cast("decimal(16,0)")).try_cast("decimal(38,0)") + (F.col("off") * down).cast("decimal(32,0)")
    bottom = (F.col("den") * down).cast("decimal(30,0)")
    fits = F.abs(F.col("_top").cast("double")) < F.lit(9.0e18) * F.col("_bottom").cast("double")
    half = F.when(fits, F.expr("(2 * abs(_top) + _bottom) div (2 * _bottom)"))
    return j.withColumn("_top", top).withColumn("_bottom", bottom).withColumn("base_value", (F.signum(F.col("_top")).cast("int") * half).cast("bigint")).drop("_top", "_bottom", "num", "off", "den")


def common_units(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, row_idx, col_idx, base_value) of every measured value.

    Nulls, blanks and words for unknown give no row; so do texts without a unit anywhere. Repeated samples come out each;
    an empty table gives none. A value of more than 18 digits, or one whose conversion exceeds a bigint, has no base_value and gives
    none; rejected_values() lists it.
    """
    return to_base(measured_values(samples, key)).where(F.col("base_value").isNotNull()).select(key, "row_idx", "col_idx", "base_value")


def rejected_values(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, row_idx, col_idx, digits, unit, reject): measured values that have no base value, as they were read."""
    return to_base(measured_values(samples, key)).where(F.col("base_value").isNull()).select(key, "row_idx", "col_idx", "digits", "unit", F.lit("exceeds the range of a base value").alias("reject"))
