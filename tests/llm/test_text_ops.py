import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tesserae.llm import boilerplate, lang, leakage, near_dup, packing, pairs, sentences, splitting, tails, truncation

# --- near duplicates


def brute_pairs(rows, t):
    sets = [(k, set(re.findall(r"[^\W_]+", q.lower()))) for k, q in rows if q is not None]
    out = set()
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and len(x & y) >= t * len(x | y) - 1e-9:
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("bucket_rows", [3, 2000])
def test_near_duplicates_equal_brute_force(spark, bucket_rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(bucket_rows)
    vocab = [f"w{i}" for i in range(40)]
    base = [rng.sample(vocab, rng.randint(3, 14)) for _ in range(25)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rng.shuffle(w)
        rows.append((i, " ".join(w).upper() if i % 3 else ", ".join(w)))
    rows += [(900, None), (901, ""), (902, "?!"), (903, rows[0][1]), (904, rows[0][1]), (905, "word " * 5000 + "unique")]
    df = spark.createDataFrame(rows, "seq bigint, question string").selectExpr("*", "'x' AS cls", "1 AS toks", "2 AS bucket")
    sets = near_dup.ordered_sets(near_dup.classes(df, "seq", "question").dropDuplicates(["cls"]).select("cls", "words"))
    links = near_dup.similar_classes(sets, 0.7, bucket_rows).collect()
    assert len({tuple(r) for r in links}) == len(links)
    got = [tuple(r) for r in near_dup.similar_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows, 0.7)


def test_groups_follow_links(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "a b c d e f g h l k"), (4, "z y"), (5, "Z y"), (6, None)]
    got = {r.seq: r for r in near_dup.duplicate_groups(spark.createDataFrame(rows, "seq bigint, question string")).collect()}
    assert got[1].group_id == got[2].group_id == got[3].group_id != got[4].group_id == got[5].group_id
    assert got[4].class_id == got[5].class_id and got[2].n_links == 2 and got[6].class_id is None and got[6].n_links == 0
    assert near_dup.similar_pairs(spark.createDataFrame([], "seq bigint, question string")).count() == 0


# --- leakage


def test_leaks_equal_brute_force_on_both_ways(spark, monkeypatch):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 12, 30, 60])))) for i in range(30)] + [(90, None), (91, ""), (92, "a " * 40)]
    docs = []
    for d in range(120):
        w = rng.choices(vocab, k=rng.randint(0, 80))
        if d % 2:
            x = items[rng.randrange(30)][1].split()
            n = min(len(x), rng.randint(9, 20))
            s = rng.randint(0, len(x) - n)
            w[len(w) // 2 : len(w) // 2] = [t.upper() + rng.choice([",", "", " -"]) for t in x[s : s + n]]
        docs.append((d, " ".join(w)))
    docs += [(900, None), (901, ""), (902, "a " * 30), (902, "a " * 30)]
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda t: {tuple(words(t)[i : i + 12]) for i in range(len(words(t)) - 11)}
    want = {(d, i) for d, t in docs if t for i, q in items if q and grams(t) & grams(q)}
    dd = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(5))
    ii = spark.createDataFrame(items, "item_id bigint, item_text string").withColumn("text", F.lit("x"))
    for limit in (200_000, 1):
        monkeypatch.setattr(leakage, "BROADCAST_ROWS", limit)
        got = [tuple(r) for r in leakage.leaks(dd, ii).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    monkeypatch.setattr(leakage, "PART_CHARS", 400)
    assert {tuple(r) for r in leakage.leaks(dd, ii).collect()} == want


# --- splitting


def brute_boundary(t, limit):
    for k, rx in zip(splitting.KINDS, (r"\r?\n(?:[ \t\r]*\n)+", r"\r?\n", r"[ \t\r\n]+"), strict=False):
        if max(map(len, re.split(rx, t))) <= limit:
            return k
    return "none"


def random_text(rng, n):
    return "".join(rng.choice(["word", "longerword", " ", "  ", "\n", "\r\n", "\n\n", "\n \t\n", "é", "x" * 30]) for _ in range(n))


@pytest.mark.parametrize("size", [64, 1 << 16])
def test_boundary_over_ranges(spark, size, monkeypatch):
    rng = random.Random(size)
    texts = [(i, random_text(rng, rng.randint(0, 120))) for i in range(80)] + [(900, None), (901, ""), (902, " " * 500), (903, "\n" * 400), (904, "x" * 61)]
    real = splitting.ranges
    monkeypatch.setattr(splitting, "ranges", lambda df, k, t: real(df, k, t, size, 600))
    df = spark.createDataFrame(texts, "k int, t string").selectExpr("*", "1 AS level", "2 AS part", "3 AS n")
    got = {r.k: r.boundary for r in splitting.sufficient_boundary(df, "k", "t", 60).collect()}
    assert got == {k: brute_boundary(t, 60) for k, t in texts if t and len(t) > 60}


def test_pieces_give_the_text_back(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(splitting, "SEGMENT", 1024)
    monkeypatch.setattr(splitting, "RANGE", 256)
    real = splitting.ranges
    monkeypatch.setattr(splitting, "ranges", lambda df, k, t: real(df, k, t, 256, 64))
    texts = {i: random_text(rng, rng.randint(30, 900)) for i in range(25)} | {99: "y" * 3000}
    df = spark.createDataFrame([*texts.items(), (100, None)], "k int, t string")
    by = {}
    for r in splitting.split_texts(df, "k", "t", 200, 20).orderBy("k", "piece").collect():
        by.setdefault(r.k, []).append(r)
    assert set(by) == {k for k, t in texts.items() if len(t) > 200}
    for k, rows in by.items():
        parts = [r.text for r in rows]
        assert max(map(len, parts)) <= 200 and [r.piece for r in rows] == list(range(len(rows)))
        whole = parts[0]
        for a, b in zip(parts, parts[1:], strict=False):
            assert a[-20:] == b[:20]
            whole += b[20:]
        assert whole == texts[k]


def test_files_are_read_in_byte_ranges(spark, tmp_path):
    rng = random.Random(2)
    t = random_text(rng, 3000) + "日本語テキスト" * 40
    (tmp_path / "a.txt").write_bytes(t.encode())
    (tmp_path / "b.txt").write_bytes(b"short")
    (tmp_path / "e.txt").write_bytes(b"")
    rows = splitting.split_files(spark, [str(tmp_path / x) for x in ("a.txt", "b.txt", "e.txt")], 300, 30, file_range=1000).orderBy("path", "start").collect()
    a = [r.text for r in rows if r.path.endswith("a.txt")]
    assert a[0] + "".join(x[30:] for x in a[1:]) == t and max(map(len, a)) <= 300
    assert [r.text for r in rows if r.path.endswith("b.txt")] == ["short"]


# --- packing


def test_plan_places_every_item_and_wastes_little():
    rng = random.Random(1)
    for _ in range(10):
        hist = {}
        for _ in range(rng.randint(1, 400)):
            n = min(2048, max(1, int(rng.lognormvariate(5, 1))))
            hist[n] = hist.get(n, 0) + 1
        p = packing.plan(hist)
        placed = {}
        for cap, got, times in p:
            assert sum(got) <= cap and cap in packing.SIZES
            for s in got:
                placed[s] = placed.get(s, 0) + times
        assert placed == hist
        total = sum(n * c for n, c in hist.items())
        assert sum(t for _, _, t in p) <= math.ceil(total / 512) + 2
    assert packing.plan({}) == []


def test_pack_rows(spark):
    rows = [(i, "word " * n) for i, n in enumerate([0, 1, 5, 5, 5, 700, 3000, 2000])] + [(50, None), (51, ""), (52, "same text"), (53, "same text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("capacity", F.lit("x")).withColumn("salt", F.lit(1))
    got = packing.pack(df.select("doc_id", "text", "capacity", "salt")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {r[0] for r in rows} and all(len(v) == 1 for k, v in by.items() if k != 6) and len(by[6]) == 2
    assert all(by[k][0].container_id is None for k in (0, 50, 51))
    fill = {}
    for r in got:
        if r.container_id is not None:
            fill.setdefault((r.container_id, r.capacity), []).append((r.slot, r.n_tokens))
    assert sorted(c for c, _ in fill) == list(range(len(fill)))
    for (_, cap), v in fill.items():
        assert sum(n for _, n in v) <= cap and sorted(s for s, _ in v) == list(range(len(v)))
    assert packing.pack(df.select("doc_id", "text").limit(0)).count() == 0


# --- truncation


@pytest.mark.parametrize(
    ("tail", "intact", "state"),
    [
        ("It is done.", None, "done"), ("It was the ri", None, "open"), ("so that is\n- Name", None, "item"), ("he said: “It is done.", None, "broken"), ("Step 1: a.\nStep 2:", None, "broken"),
        ("the answer is 12.", "12.57 m", "broken"), ("Answer: 12.57 m", "12.57 m", "done"), ("cut he�", None, "broken"), ("cut he [truncated]", None, "broken"), ("blieb leer…", None, "mark"),
        ("see Dr.", None, "broken"), ("| a | 1 |", None, "done"), ("完了した。", None, "done"), ("", None, "done"),
    ],
)
def test_tail_states(tail, intact, state):
    assert tails.look(tail, intact)[0] == state


def test_spikes_and_transfers(spark):
    rng = random.Random(6)
    rows = []
    sentence = lambda: f"Row {rng.randint(1, 99)} says {rng.randint(1700, 2000)}, so that is too late."
    for i in range(400):
        t = " ".join(sentence() for _ in range(rng.randint(2, 12)))
        if i % 20 == 3:
            t += " OK, done"
        rows.append((i, "a", t[:300], None))
    rows += [(1000 + i, "b", " ".join(sentence() for _ in range(4)), None) for i in range(50)]
    rows += [(2000, "b", "Row 4 says 17", None), (2001, "b", "Row 4 says it is lat�", None), (2002, "b", None, None), (2003, "b", "none", None), (2004, None, "What? Ok.", "x"), (2005, "b", "", None)]
    df = spark.createDataFrame(rows, "seq bigint, setting string, t string, q string").selectExpr("*", "1 AS field", "2 AS source", "3 AS n_chars")
    cut, _ = truncation.cut_values(df.select("seq", "setting", "t", "q"), ["t"], prompt="q")
    got = {(r.seq, r.cause) for r in cut.collect()}
    want = {(i, "limit") for i, s, t, _ in rows if s == "a" and len(t) == 300 and not t.endswith(".")} | {(2000, "transfer"), (2001, "transfer")}
    assert want and got == want
    share = {r.source: r for r in truncation.cut_share(df.select("seq", "setting", "t", "q"), ["t"], prompt="q").collect()}
    assert share["b"].n_cut == 2 and share["a"].n_at_limit == len(want) - 2 and share[""].n_cut == 0
    empty, _ = truncation.cut_values(df.select("seq", "setting", "t", "q").limit(0), ["t"])
    assert empty.count() == 0


def test_copies_are_no_closing_phrase(spark):
    rows = [(i, "a", f"The mill number {i} was sold. It was {'old ' * (i % 7)}then.") for i in range(40)]
    rows += [(100 + i, "a", "The mill was sold. Its owner went to the near") for i in range(20)]
    rows += [(200 + i, "b", f"The mill was {'very ' * i}old.") for i in range(9)] + [(300 + i, "b", "- The longest of all the items that have ever been in this list of old mills and their bridges") for i in range(8)]
    cut, _ = truncation.cut_values(spark.createDataFrame(rows, "seq int, setting string, t string"), ["t"])
    assert sorted(r.seq for r in cut.collect()) == list(range(100, 120))


# --- broken pairs


def held_out(n=400, seed=21):
    rng = random.Random(seed)
    names = [f"{a}{b}" for a in ("Mar", "Tel", "Bor", "Kes", "Dol") for b in ("nevan", "timen", "lazar", "ropen")]
    rows = []
    for i in range(n):
        a, b, c = (rng.choice(names) for _ in range(3))
        ans = rng.choice([f"It was {a}.", a, f"{rng.randint(2, 999)} m"])
        said = [
            [f"I cannot find {b} in Document 3, but Document 5 describes the same mill.", f"Unfortunately, {c} has two entries, and I must decline the later one.", f"The filter leaves 2 candidates: {b} and {c}.", f"Sorting by year puts {b} ahead of {c}."],
            [f"La torre de {b} fue vendida en 1870 y no se sabe por quién.", f"En {c} vivía la familia; su casa daba a la mina.", f"El gasto de la obra subió hasta {rng.randint(20, 99)} coronas.", f"No hubo otra torre junto a {b}."],
            [f"Die alte Mühle bei {b} wurde von der Gemeinde verkauft.", f"Das Haus steht nicht mehr in {c}.", f"Nach der Karte lag die Mühle im Bezirk {b}.", f"Wer hat die Brücke bei {c} bezahlt?"],
        ][i % 3]
        steps = [rng.choice(said) for _ in range(rng.randint(2, 5))]
        q = [f"Which of the mills near {a} was built by {b} and sold to the {c} estate?", f"¿Qué obra de {a} fue vendida a {b} y descrita por {c} para la torre?", f"Welche Anlage bei {a} wurde an {b} verkauft und nach {c} benannt?"][i % 3]
        rows.append({"seq": i, "sample_id": i, "question": q, "intact": ans, "final_answer_sql": ans, "llm_generated_reasoning_traces": "\n".join([*steps, f"{['Final answer', 'Respuesta', 'Antwort'][i % 3]}: {ans}"]) if i % 5 else "\n".join(steps)})
    return rows


@pytest.fixture(scope="module")
def model():
    return pairs.train(held_out())


def test_classifier_on_held_out_rows(model):
    got, y = pairs.labelled(held_out(200, seed=77), 78, 1)
    said = [model.defect(p) for p in got]
    for k, d in enumerate(pairs.DEFECTS):
        mine = [s for s, row in zip(said, y, strict=True) if row[k]]
        assert mine and sum(s == d for s in mine) >= 0.9 * len(mine), d
    every = [s == pairs.DEFECTS[row.argmax()] for s, row in zip(said, y, strict=True) if row.any()]
    assert sum(every) > 0.95 * len(every)
    clean = [s for s, row in zip(said, y, strict=True) if not row.any()]
    assert sum(s is not None for s in clean) <= 0.02 * len(clean)


def test_decisions(model):
    q = "Which of the mills near Alpha was built by Beta and sold to the Gamma estate?"
    hit = lambda t, g=None, ans=False: model.defect(pairs.Pair(q, t, g, ans, {}))
    for t in (None, "", " \n", "...", "none", "N/A", "```\n```", "<answer></answer>", "[[ ## reasoning ## ]]\n\n[[ ## completed ## ]]", "​", "<b> - </b>" * 60):
        assert hit(t) == "empty"
    for t in (q, q.upper(), "Q: " + q, q + "\n" + q, " ".join(q.split()[6:] + q.split()[:6])):
        assert hit(t) == "copies_question"
    assert hit(q + " It is Delta Omega.", "Delta Omega") != "copies_question"
    assert hit("Die alte Mühle wurde am 1. Mai eröffnet und ist nicht mehr da.") == "other_language" and hit("Башня построена в 1801 году.") == "other_language"
    assert hit("The mill was built by Be") == "truncated" and hit("12.5", "12.57 m", True) == "truncated" and hit("12.57 m", "12.57 m", True) is None


def test_cuts_end_in_every_script():
    for t in ("หอคอยนี้สร้างขึ้นเมื่อนานมาแล้วและยังคงตั้งอยู่ที่เดิมจนถึงทุกวันนี้ ", "这座灯塔真高！" * 20, "بني الجسر عام قديم جدا" * 8, "यह पुल बहुत पुराना है! " * 8, "?! " * 40):
        for seed in range(100):
            pairs.synthesize([{"question": "Who?", "intact": "x", "final_answer_sql": "x", "llm_generated_reasoning_traces": t}], seed)


def test_a_table_of_five_rows_is_judged(spark):
    rows = held_out(5)
    df = spark.createDataFrame([(r["seq"], r["sample_id"], r["question"], r["final_answer_sql"], None if r["seq"] == 2 else r["llm_generated_reasoning_traces"]) for r in rows], "seq bigint, sample_id bigint, question string, final_answer_sql string, llm_generated_reasoning_traces string")
    assert {(r.seq, r.defect) for r in pairs.broken_pairs(df).collect()} == {(2, "empty")}


def test_broken_pairs_on_rows(spark):
    rows = held_out(60)
    for r in rows[:4]:
        r["llm_generated_reasoning_traces"] = None
    rows[5]["question"] = None
    df = spark.createDataFrame([(r["seq"], r["sample_id"], r["question"], r["final_answer_sql"], r["llm_generated_reasoning_traces"], 1, "z") for r in rows], "seq bigint, sample_id bigint, question string, final_answer_sql string, llm_generated_reasoning_traces string, field int, intact string")
    gold = spark.createDataFrame([(r["sample_id"], r["intact"]) for r in rows], "sample_id bigint, final_answer_sql string")
    got = pairs.broken_pairs(df, gold).collect()
    assert {(r.seq, r.field) for r in got if r.defect == "empty"} == {(i, "llm_generated_reasoning_traces") for i in range(4)}
    assert pairs.broken_pairs(df, gold, pairs.Model()).columns == ["seq", "field", "defect"]
    assert pairs.broken_pairs(df.limit(0), gold).count() == 0


def test_refusal_counts_wherever_it_stands(model):
    q = "Which of the mills near Marnevan was built by Teltimen and sold to the Borlazar estate?"
    said = "I'm sorry, but I cannot answer this question."
    why = [f"Document {i} describes the mill at Kesropen and its {i} gates in some detail, and the next one lists its owners." for i in range(2, 7)]
    for t in (" ".join([said, *why]), "\n".join([why[0], said, *why[1:]])):
        assert model.defect(pairs.Pair(q, t, "Dolnevan", False, {})) == "refusal"
    assert model.defect(pairs.Pair(q, " ".join([said, *why, "Final answer: Dolnevan"]), "Dolnevan", False, {})) is None
    assert model.defect(pairs.Pair(q, " ".join(why), "Dolnevan", False, {})) is None


def test_long_responses_are_read_whole(model):
    q = "Which of the mills near Alpha was built by Beta and sold to the Gamma estate before the old bridge at Delta was taken down?"
    hit = lambda t: [model.defect(pairs.Pair(q, t, None, False, {}))]
    assert "copies_question" in hit(" ".join([q] * 5)) and "copies_question" in hit("\n".join([q.rstrip("?")] * 5))
    own = "The mill was built by the owner of the estate and it was sold in the year that the bridge was taken down. " * 8
    other = "Die alte Mühle wurde von der Gemeinde gekauft und ist nicht mehr in dem Ort, der sie für sich haben wollte. " * 200
    assert "other_language" in hit(own + other + own) and "other_language" not in hit(own * 5 + other[:500] + own * 5)
    assert "copies_question" not in hit(q + " " + own) and "other_language" in hit(f"{q}\n{other[:600]}")


# --- boilerplate


def page(i, lead="The old mill at Nordhaven was finished in 1901"):
    body = f"{lead} and carries {i} gates. It opened at 6 a.m. and shut at 9 p.m. on fair days. The {i} repairs never lasted longer than a month, said the keeper."
    return f"Home\nNews\nContact\n\nNordhaven Mills {chr(65 + i % 26)}x\n\n{body}\n\n- It opened at 6 a.m. and shut at 9 p.m. on fair days.\n\nAdvertisement\n\n{body.replace('old', 'new')}\n\nMore from us\n» Other story\n- Third story 1999\n\n12 comments\nAnn wrote: It opened at 6 a.m. and shut.\nWe use cookies to measure visits.\nAccept all\n© 2020 Some Media. All rights reserved."


def test_furniture_lines(spark):
    rows = [("article", f"p{i}", "h1" if i % 3 else f"solo{i}", f"Nordhaven Mills {chr(65 + i % 26)}x" if i % 2 else None, page(i)) for i in range(12)] + [("article", "n", None, None, None), ("article", "e", "h1", None, ""), ("article", "p0", "h1", None, page(0))]
    df = spark.createDataFrame(rows, "place string, item_key string, host string, title string, text string").withColumn("host", F.coalesce("host", F.lit(""))).withColumn("titles", F.to_json(F.array(F.struct("title", "host")))).withColumn("score", F.lit("x")).withColumn("path", F.lit(1))
    got = {}
    for r in boilerplate.furniture_lines(df).distinct().collect():
        got.setdefault(r.item_key, set()).add(r.line_no)
    lines = page(1).split("\n")
    want = {i for i, x in enumerate(lines, 1) if x and not (x.startswith(("The old", "The new", "Nordhaven", "- It opened")))}
    assert set(got) == {f"p{i}" for i in range(12)} and all(v == want for v in got.values())
    bodies = {r.item_key: r.body for r in boilerplate.main_bodies(df.where("item_key <> 'p0'")).collect()}
    assert "cookies" not in bodies["p1"] and "The old mill" in bodies["p1"] and bodies["n"] is None
    assert boilerplate.furniture_lines(df.limit(0)).count() == 0


def test_prose_that_a_host_repeats_is_furniture(spark):
    notice = "We and our partners store data on your device. You may refuse this at any time in the settings. Until you do so we take it that you agree to all of it."
    own = "The old mill at {0} was finished in 19{1:02d} and carries {1} gates. It opened at 6 a.m. and shut at 9 p.m. The {1} repairs never lasted longer than a month, said {0}."
    rows = [(f"a{i}", "h1" if i < 8 else f"s{i}", f"Mill of {chr(65 + i)}x", own.format(f"Nord{chr(97 + i)}", i) + "\n\n" + notice) for i in range(10)]
    arts = spark.createDataFrame([(k, h, t, x) for k, h, t, x in rows], "basename string, site string, title string, page_text string")
    ctx = spark.createDataFrame([(1, [rows[0][0], rows[9][0]], "==========\n**Document 1**: \n\n\nMill of Ax\n\n" + rows[0][3] + "\n==========\n**Document 2**: \n\n\nMill of Jx\n\n" + rows[9][3]), (2, None, None)], "sample_id bigint, relevant_web_articles array<string>, context string")
    pages = boilerplate.article_pages(arts).unionByName(boilerplate.context_pages(ctx, arts))
    got = {(r.item_key, r.line_no) for r in boilerplate.furniture_lines(pages).collect()}
    assert got == {(f"a{i}", 3) for i in range(8)} | {("1", 9)}  # the second document's host has one page
    again = boilerplate.furniture_lines(pages.repartition(7).orderBy(F.rand(3))).collect()
    assert {(r.item_key, r.line_no) for r in again} == got


# --- sentences


def test_layout_units_and_positions():
    t = sentences.Tagger()
    text = "# Head\r\n\r\n1. One. Two.\n2. Three\n\n| a | b |\n|---|---|\n\nQuestion: x? y\nAnswer: z\n\n  para one \nwrapped  \n"
    got = [text[a:b] for a, b in sentences.split(text, t)]
    assert got == ["# Head", "1. One. Two.", "2. Three", "| a | b |", "|---|---|", "Question: x? y", "Answer: z", "para one \nwrapped"]
    assert sentences.split("", t) == [] and sentences.split(" \n\t", t) == []


POOL = [
    "Dr. Alder of Brim measured a drop of 3.5 m near the mill.", "“Why did it close?” asked the clerk at Brim.", "The list is kept at www.a.example/v5.1/index.html for now.", "What a narrow mill!", "It opened at 6 a.m. and shut at 9 p.m. on fair days.",
    "However, the council had already voted against it…", "The owner was listed as Brim Bros. Inc.", "75 boats were lost near Brim that winter.", "“The tide came early. Nobody was warned,” wrote Alder in a letter of 1990.", "J. R. Alder drew the plans, while St. Brim parish lent the land.",
]
THAI = ["มีบ้าน 72 หลังใกล้หอดูดาว", "ใครเป็นผู้จ่ายค่าสะพาน", "ความสูงคือ 69.1 เมตรตามบันทึกของมาวัน"]


def test_tagger_learns_from_items():
    t = sentences.Tagger().train(sentences.synthesize([POOL, THAI], 1500))
    rng = random.Random(9)
    for _ in range(200):
        chosen = rng.sample(POOL, 4)
        text = " ".join(chosen)
        assert [text[a:b] for a, b in sentences.split(text, t)] == chosen
    text = " ".join(THAI)
    assert [text[a:b] for a, b in sentences.split(text, t)] == THAI


def test_viterbi_is_the_best_sequence():
    rng = random.Random(0)
    t = sentences.Tagger()
    t.w = {f: rng.uniform(-2, 2) for f in range(20)}
    t.t = {(a, g, b): rng.uniform(-2, 2) for a in (0, 1) for b in (0, 1) for g in range(7)}
    for n in range(1, 8):
        ps = [(i, i, [rng.randrange(20), rng.randrange(20)], rng.randrange(7)) for i in range(n)]

        def total(tags, ps=ps):
            s, last = 0.0, 1
            for (_, _, feats, g), y in zip(ps, tags, strict=True):
                s += (sum(t.w[f] for f in feats) if y else 0.0) + t.t[last, g, y]
                last = y
            return s

        best = max(([m >> i & 1 for i in range(n)] for m in range(1 << n)), key=total)
        assert abs(total(t.decode(ps)) - total(best)) < 1e-9


def test_sentences_on_rows(spark):
    lists = "\n".join(f"- {s}" for s in POOL)
    rows = [(1, " ".join(POOL[:3])), (2, None), (3, ""), (4, lists), (4, lists), (5, " ".join(POOL) * 300)] + [(10 + i, lists) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS k", "2 AS start_pos")
    got = {}
    for r in sentences.sentences(df).collect():
        got.setdefault(r.doc_id, []).append((r.start_pos, r.end_pos))
    assert 2 not in got and 3 not in got and len(got[4]) == 20
    assert [rows[0][1][a:b] for a, b in sorted(got[1])] == POOL[:3]
    assert sentences.sentences(df.limit(0)).count() == 0


def test_language_votes():
    assert lang.best(lang.votes("The mill was built by the keeper of it"))[0] == "en"
    assert lang.best(lang.votes("これは見事な灯台だ"))[0] == "kana" and lang.best(lang.votes(""))[0] == ""


def test_corpus_without_lists_is_split(spark):
    text = "The bridge was built in 1841. It still stands. Who paid for it? Dr. Bell wrote that 3.5 tons were lost."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    got = [text[r.start_pos : r.end_pos] for r in sentences.sentences(df).orderBy("start_pos").collect()]
    assert got == ["The bridge was built in 1841.", "It still stands.", "Who paid for it?", "Dr. Bell wrote that 3.5 tons were lost."]
    assert sentences.sentences(df.limit(0)).count() == 0


def test_candidates_equal_the_pattern():
    rng = random.Random(4)
    for _ in range(3000):
        p = "".join(rng.choice("ab AZ9.!?…。»”\"[1] (¿\n*ก|:") for _ in range(rng.randint(0, 40)))
        assert list(sentences.candidates(p)) == [m.span() for m in sentences.CANDIDATE.finditer(p)], p


def test_segments_end_at_boundaries(spark):
    rng = random.Random(8)
    text = "\n".join(" ".join("word%d" % rng.randint(0, 9) for _ in range(12)) for _ in range(16000))
    text = text[:65500] + " \n" * 900 + text[65500:]  # a run of blanks across a range's end, longer than a halo
    assert len(text) > splitting.SEGMENT + 100_000
    df = spark.createDataFrame([(1, text), (2, "x" * 70_000), (3, text[:60_000]), (4, None)], "k int, t string")
    rows = {}
    for r in splitting.split_texts(df, "k", "t").collect():
        rows.setdefault(r.k, []).append(r)
    for k, whole in ((1, text), (2, "x" * 70_000), (3, text[:60_000])):
        got = sorted(rows[k], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got))) and all(len(r.text) <= 4000 and r.text == whole[r.start : r.end] for r in got)
        assert got[0].start == 0 and got[-1].end == len(whole) and all(b.start == a.end - 200 for a, b in zip(got, got[1:]))
    assert {r.boundary for r in rows[1]} == {"paragraph", "line", "end"}
    assert all(text[r.end - 1] == "\n" for r in rows[1][:0] + [r for r in rows[1] if r.boundary == "line"])
    assert {r.k: r.boundary for r in splitting.sufficient_boundary(df, "k", "t").collect()} == {1: "line", 2: "none", 3: "line"}
    ends = splitting.ranges(df.where("k = 1"), "k", "t").collect()
    assert any(r.before > splitting.HALO for r in ends) or any(len(r.t) - r.before - r.chars > splitting.HALO for r in ends)
