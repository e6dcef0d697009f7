"""Sentence boundaries across languages and scripts: a linear-chain model over characters, decoded by Viterbi.

Every character is tagged as boundary or inside. Only characters after a terminal mark and its closers, and in scripts
without such marks the blanks, can be a boundary; all others are inside for certain, so the chain is decoded over the
places left, with transitions that know the distance to the last one. Headings, list items, table rows, steps and
question or answer lines are sentences by their layout. The model is an averaged structured perceptron trained on the
corpus itself: list items are complete sentences, so items put one after another give paragraphs whose boundaries are
known; for scripts without punctuation the items are stripped of it first.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.session import spread, thinned

TRAIN_DOCS = 4000  # documents, at most, whose list items the model is trained on
TRAIN_ITEMS = 40  # items of one document, at most, that are used for training
TRAIN_SEQUENCES = 6000
EPOCHS = 5

TERMINAL = ".!?…。！？｡।॥؟۔։።"
THAI = "฀-๿"
UNPUNCTUATED = f"{THAI}຀-໿ក-៿"  # scripts that part sentences by blanks
CLOSERS = "\"'”’“»)\\]）」』】›"
CANDIDATE = re.compile(
    rf"(?:[{re.escape(TERMINAL)}]+(?:[ \u00a0\u202f]?»|[{CLOSERS}]|\[\d+\]|[¹²³⁰-⁹]+|\*+(?=\s|$))*)(?:(?=\s|$)|(?<=[…。！？｡।॥؟۔”」』）»])|(?=[“„«¿¡(「『]))"
    rf"|(?<=[^\W\d_A-Z]{{2}})[.!?]+(?=[A-ZÀ-ÞА-Я“„«¿¡])|(?<=\d[.!?])(?=[A-ZÀ-ÞА-Я])"  # a blank left out
    rf"|(?<=[{UNPUNCTUATED}])[ \u00a0\u202f\u3000]+(?=[^\s\d])|(?<=[^\s\d])[ \u00a0\u202f\u3000]+(?=[{UNPUNCTUATED}])"  # next to a digit it ends nothing
)
BLANK = re.compile(r"[ \t\r\u00a0\u202f\u3000\u200b\ufeff]*$")
MARKER = re.compile(r"\s*(?:[-*•‣▪–—]\s|(\d{1,3})[.)]\s)")
HEADING = re.compile(r"\s*#{1,6}\s")
ROW = re.compile(r"\s*\|")
LABEL = re.compile(r"\s*(?:\*\*)?(?:(?:step|schritt|étape|paso|passo|шаг)\s*\d+|question|answer|q|a|frage|antwort|pregunta|respuesta|réponse|вопрос|ответ|问题|问|答案|答|質問|回答|प्रश्न|उत्तर|سؤال|جواب|คำถาม|คำตอบ)(?:\*\*)?\s?[:：]", re.I)
TERM = re.compile(f"[{re.escape(TERMINAL)}]")
SPARSE = re.compile(f"[{UNPUNCTUATED}]")
CAPITAL = re.compile("[A-ZÀ-ÞА-Я]")
OPENERS, SHUTTERS = "“„«「『(（", "”»」』)）"
QUOTES, BRACKETS = tuple("\"'”’“»」』›"), tuple(")）]")
MARKS = re.compile(f'["{OPENERS}{SHUTTERS}]')
DIGIT = re.compile(r"\d")
BLANKS = " \u00a0\u202f\u3000"
HASH = 1 << 18
CACHED = 200_000  # hashed features that a task keeps
#: Sentences that the tagger learns from beside the corpus's own list items, so that it works without any.
SEEDS = [
    ["Dr. Hale measured the tower at about 4.5 metres.", "The old mill was sold in 1871.", "Who paid for the new roof?", "“It was cold,” the clerk wrote, “and nobody came.”", "The owner (see Fig. 3) lived near St. Mary.", "What a long bridge!", "It has 3,400 stones, i.e. more than the other one.", "Mr. J. Bell later moved to the U.S. archive."],
    ["Dr. Berger schätzte die Höhe auf ca. 7,5 m.", "Die Mühle wurde am 3. Mai 1871 verkauft.", "Wer hat das Dach bezahlt?", "„Es war kalt“, schrieb der Müller, „und niemand kam.“", "Nach Abb. 4 lag das Haus am Fluss.", "Was für eine lange Brücke!", "Dort stehen z. B. noch zwei Türme."],
    ["Le Dr Morel cite p. ex. la halle du village.", "La vieille tour fut vendue en 1871.", "Qui a payé le toit ?", "« Il faisait froid », écrit M. Petit.", "Le pont compte 3,5 arches de plus.", "Quelle longue digue !"],
    ["El Sr. Ruiz midió una altura de 7,5 m.", "La torre vieja se vendió en 1871.", "¿Quién pagó el tejado?", "¡Qué puente tan largo!", "«Hacía frío», escribió la Dra. Vega.", "El gasto subió a unas 3.400 coronas, es decir, mucho."],
    ["Башня построена в 1871 г. и стоит до сих пор.", "Кто оплатил крышу?", "«Было холодно», — писал мастер.", "Высота составляет 7,5 м, т. е. больше прежней.", "Какой длинный мост!"],
    ["这座塔建于1871年。", "谁支付了屋顶的费用？", "“天很冷。没有人来。”工匠写道。", "这座桥真长！", "高度约为7.5米。"],
    ["この塔は1871年に建てられた。", "誰が屋根の費用を払ったのか？", "「寒かった。誰も来なかった」と職人は書いた。", "なんと長い橋だろう！", "高さは7.5メートルである。"],
    ["بني البرج عام 1871.", "من دفع ثمن السقف؟", "«كان الجو باردا»، كتب العامل.", "ما أطول هذا الجسر!"],
    ["यह मीनार 1871 में बनी थी।", "छत का खर्च किसने दिया?", "“ठंड थी।” डॉ. राव ने लिखा।", "कितना लंबा पुल है!"],
    ["หอคอยนี้สร้างเมื่อ 1871", "ใครเป็นผู้จ่ายค่าหลังคา", "ความสูงคือ 7.5 เมตรตามบันทึก", "สะพานนี้ยาวมาก"],
]


def shape(ch: str, nxt: str) -> str:
    if not ch:
        return "end"
    if ch.isdigit():
        return "digit"
    if ch in "“„«「『‘":
        return "openq"
    if ch in "(（[":
        return "open("
    if ch in "¿¡":
        return "invert"
    if ch in "—–-":
        return "dash"
    if ch in "\"'":
        return "ascii"
    if "฀" <= ch <= "๿":
        return "thai"
    if ch > "぀":
        return "cjk"
    if ch.islower():
        return "eX" if nxt.isupper() else "lower"
    if ch.isupper():
        return "upper"
    if ch.isalpha() or ch > "؀":
        return "other"
    return "punct"


def lines_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of each line; kinds: blank, unit (a sentence by its layout), text."""
    at, before = 0, "blank"
    for line in text.split("\n"):
        end = at + len(line)
        if BLANK.match(line):
            kind = "blank"
        elif ("#" in line and HEADING.match(line)) or ("|" in line and ROW.match(line)) or ((":" in line or "：" in line) and LABEL.match(line)):
            kind = "unit"
        elif before != "text" and MARKER.match(line):
            kind = "unit"
        else:
            kind = "text"
        yield at, end, kind
        before, at = kind, end + 1


def spans_of(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, is a unit): units line by line, paragraphs as runs of text lines."""
    start = -1
    last = 0
    for a, b, kind in lines_of(text):
        if kind == "text":
            if start < 0:
                start = a
            last = b
            continue
        if start >= 0:
            yield start, last, False
            start = -1
        if kind == "unit":
            yield a, b, True
    if start >= 0:
        yield start, last, False


def candidates(p: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what CANDIDATE finds. Outside the scripts that part sentences by blanks every candidate is at a
    terminal mark, so only those are tried."""
    if SPARSE.search(p):
        yield from (m.span() for m in CANDIDATE.finditer(p))
        return
    at = 0
    while m := TERM.search(p, at):
        i = m.start()
        c = CANDIDATE.match(p, i)
        if c and c.end() > i:
            yield c.span()
            at = c.end()
            continue
        at = i + 1
        if i and p[i] in ".!?" and p[i - 1].isdecimal() and CAPITAL.match(p, at):  # a blank left out after a number
            yield at, at


_HASHES: dict[tuple, list[int]] = {}


def hashes(key: tuple, feats: Callable[[], list[str]]) -> list[int]:
    """The hashed features that a combination of properties stands for."""
    got = _HASHES.get(key)
    if got is None:
        if len(_HASHES) >= CACHED:
            _HASHES.clear()
        got = _HASHES[key] = [zlib.crc32(f.encode()) % HASH for f in feats()]
    return got


def places(p: str) -> list[tuple[int, int, list[int]]]:
    """(end of the sentence there, start of what follows, hashed features) of every possible boundary inside p."""
    out = []
    depth, at = 0, 0
    ascii_q = 0
    prev_end = 0
    for s, e in candidates(p):
        mark = p[s:e]
        blank = bool(mark) and mark[0] in BLANKS
        if blank:
            end, nxt = s, e
        else:
            end = nxt = e
            while nxt < len(p) and p[nxt].isspace():
                nxt += 1
        if nxt >= len(p):
            break
        for m in MARKS.finditer(p, at, e):
            ch = m.group()
            if ch in OPENERS and not (ch == "“" and depth > 0 and "„" in p[at:e]):
                depth += 1
            elif ch in SHUTTERS or ch == "“":
                depth = max(0, depth - 1)
            elif ch == '"':
                ascii_q ^= 1
        at = e
        gap = p[end:nxt]
        g = "none" if not gap else "nl" if "\n" in gap else "two" if len(gap) > 1 else "one"
        near = p[max(0, s - 24) : s]
        before = near.rsplit(None, 1)[-1] if near and not near[-1].isspace() else ""
        after = p[nxt : nxt + 16].split(None, 1)[0].lower()
        c, d = p[nxt], p[nxt + 1] if nxt + 1 < len(p) else ""
        sh = shape(c, d)
        inner = "n" if before[-1:].isdigit() else "1" if len(before) == 1 else "." if "." in before else "U" if before[:1].isupper() else "w"
        if blank:
            inner = "digit" if (before[-1:].isdigit() or c.isdigit()) else "text"
        core = mark.strip(BLANKS)
        k = "blank" if blank else (core[:1] or ".") + ("..." if core.startswith("...") else "") + ("q" if core[-1:] in QUOTES else ")" if core[-1:] in BRACKETS else "")
        low = DIGIT.sub("9", before.lower().lstrip("([\"'“„«'")[-12:])
        q = f"{min(depth, 2)}{ascii_q}"
        feats = (
            hashes((k, sh, g, inner, q, before == ""), lambda: ["b", f"k{k}", f"s{sh}", f"g{g}", f"ks{k}|{sh}", f"kg{k}|{g}", f"i{inner}|{sh}|{k}", f"q{q}|{k}", f"q{q}|{sh}|{k}", f"sp{before == ''}|{k}"])  # noqa: B023
            + hashes((k, sh, inner if blank else low, blank), lambda: [f"x{inner}", f"xs{inner}|{sh}"] if blank else [f"w{low}|{k}", f"ws{low}|{sh}"])  # noqa: B023
            + hashes((k, after), lambda: [f"a{after}|{k}"])  # noqa: B023
        )
        gap_class = min(6, (end - prev_end) // 8)
        prev_end = end
        out.append((end, nxt, feats, gap_class))
    return out


class Tagger:
    """Weights of the emissions by hashed feature, and of transitions by (last tag, distance class, tag)."""

    def __init__(self) -> None:
        self.w: dict[int, float] = {}
        self.t: dict[tuple[int, int, int], float] = {}

    def decode(self, ps: list) -> list[int]:
        """Viterbi over the places: the tags (1 boundary, 0 inside) of greatest total weight."""
        w, t = self.w, self.t
        a0, a1 = 0.0, 0.0
        back = []
        for i, (_, _, feats, gap) in enumerate(ps):
            e = 0.0
            for f in feats:
                e += w.get(f, 0.0)
            if i == 0:
                a0, a1 = t.get((1, gap, 0), 0.0), e + t.get((1, gap, 1), 0.0)
                back.append((1, 1))
                continue
            z0, z1 = a0 + t.get((0, gap, 0), 0.0), a1 + t.get((1, gap, 0), 0.0)
            o0, o1 = a0 + t.get((0, gap, 1), 0.0), a1 + t.get((1, gap, 1), 0.0)
            back.append((int(z1 > z0), int(o1 > o0)))
            a0, a1 = max(z0, z1), max(o0, o1) + e
        tag = int(a1 > a0)
        tags = []
        for i in range(len(ps) - 1, -1, -1):
            tags.append(tag)
            tag = back[i][tag]
        return tags[::-1]

    def train(self, data: list[tuple[list, list[int]]], epochs: int = EPOCHS, seed: int = 3) -> Tagger:
        """Averaged structured perceptron."""
        rng = random.Random(seed)
        sw: dict[int, float] = {}
        st: dict[tuple[int, int, int], float] = {}
        n = 1
        for _ in range(epochs):
            rng.shuffle(data)
            for ps, gold in data:
                got = self.decode(ps)
                if got != gold:
                    pg = pt = 1
                    for (_, _, feats, gap), y, z in zip(ps, gold, got, strict=True):
                        if y != z:
                            step = 1.0 if y else -1.0
                            for f in feats:
                                self.w[f] = self.w.get(f, 0.0) + step
                                sw[f] = sw.get(f, 0.0) + n * step
                        if (pg, y) != (pt, z):
                            for key, step in (((pg, gap, y), 1.0), ((pt, gap, z), -1.0)):
                                self.t[key] = self.t.get(key, 0.0) + step
                                st[key] = st.get(key, 0.0) + n * step
                        pg, pt = y, z
                n += 1
        self.w = {f: v - sw.get(f, 0.0) / n for f, v in self.w.items() if abs(v - sw.get(f, 0.0) / n) > 1e-9}
        self.t = {k: v - st.get(k, 0.0) / n for k, v in self.t.items()}
        return self


def split(text: str, tagger: Tagger) -> list[tuple[int, int]]:
    """(start, end) of the sentences of text, outer whitespace left out."""
    out = []

    def add(a: int, b: int) -> None:
        while a < b and (text[a].isspace() or text[a] in "\u200b\ufeff"):
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] in "\u200b\ufeff"):
            b -= 1
        if a < b:
            out.append((a, b))

    for a, b, unit in spans_of(text):
        if unit:
            add(a, b)
            continue
        p = text[a:b]
        ps = places(p)
        at = 0
        if ps:
            for (end, nxt, _, _), tag in zip(ps, tagger.decode(ps), strict=True):
                if tag:
                    add(a + at, a + end)
                    at = nxt
        add(a + at, b)
    return out


def items_of(text: str) -> list[str]:
    """The list items of a text, without their markers: sentences whose limits the layout tells."""
    out = []
    for a, b, kind in lines_of(text):
        line = text[a:b]
        if kind == "unit":
            m = MARKER.match(line)
            if m and len(line) - m.end() > 3:
                out.append(line[m.end() :].strip())
                if len(out) == TRAIN_ITEMS:
                    break
    return out


def wrap(p: str, width: int) -> str:
    lines, n = [], 0
    for w in p.split(" "):
        if lines and n + len(w) + 1 > width:
            lines.append("\n" + w)
            n = len(w)
        else:
            lines.append((" " if lines else "") + w)
            n += len(w) + 1
    return "".join(lines)


def synthesize(docs: list[list[str]], n: int = TRAIN_SEQUENCES, seed: int = 5) -> list[tuple[list, list[int]]]:
    """Paragraphs of items put one after another, as (places, gold tags)."""
    rng = random.Random(seed)
    pools: dict[str, list[str]] = {}
    for items in docs:
        for s in items:
            key = next((k for k, a, b in (("thai", "฀", "๿"), ("lao", "຀", "໿"), ("khmer", "ក", "៿"), ("kana", "぀", "ヿ"), ("han", "㐀", "鿿"), ("cyr", "Ѐ", "ӿ"), ("arab", "؀", "ۿ"), ("deva", "ऀ", "ॿ")) if any(a <= c <= b for c in s[:80])), "latin")
            pools.setdefault(key, []).append(s)
    keys = sorted(pools)
    data = []
    by_doc = [d for d in docs if len(d) > 1]
    for i in range(n):
        key = keys[i % len(keys)] if i % 2 else "latin"
        pool = pools.get(key) or pools[keys[0]]
        if key == "latin" and by_doc and rng.random() < 0.4:  # neighbours share a language
            pool = rng.choice(by_doc)
        chosen = [rng.choice(pool) for _ in range(rng.randint(2, 7))]
        if key in ("thai", "lao", "khmer"):
            chosen = [c.rstrip(TERMINAL + " ") for c in chosen]
        p, ends = "", set()
        for j, s in enumerate(chosen):
            if j:
                tight = key in ("han", "kana") and p[-1] in "。！？」”」』…）"
                r = rng.random()
                p += "" if tight or (r < 0.04 and s[0].isupper() and key in ("latin", "cyr")) else "  " if r < 0.1 else " "
            if rng.random() < 0.06 and s and s[-1] in ".!?":
                s += f"[{rng.randint(1, 99)}]"
            p += s
            ends.add(len(p))
        if rng.random() < 0.2 and key not in ("thai", "lao", "khmer"):
            p = wrap(p, rng.randint(50, 90))
        ps = places(p)
        gold = [int(x[0] in ends) for x in ps]
        if ps:
            data.append((ps, gold))
    return data


def fit_tagger(docs: DataFrame, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> Tagger:
    """Train on the list items of the train_docs documents with list items that have the least hash of their key."""
    lists = thinned(docs, key, train_docs).where(F.col(text).rlike(r"(?m)^\s*(?:[-*•]|\d{1,3}[.)])\s")).select(F.col(key).alias("k"), F.col(text).alias("t"))
    picked = lists.orderBy(F.xxhash64("k"), "k").limit(train_docs)

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "items": [items_of(t) for t in b["t"].tolist()]})

    rows = picked.mapInPandas(take, f"k {dict(docs.dtypes)[key]}, items array<string>").where(F.size("items") > 0).collect()
    tagger = Tagger()
    return tagger.train(synthesize(SEEDS + [list(r["items"]) for r in sorted(rows, key=lambda r: r["k"])]))


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """(key, start_pos, end_pos): every sentence of every text, in code points.

    Null, empty and blank texts have none. Repeated rows come out each. A corpus without list items is tagged by what the
    seeds teach.
    """
    tagger = tagger or fit_tagger(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast((tagger.w, tagger.t))  # at most HASH weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = Tagger()
        t.w, t.t = shared.value
        for b in batches:
            spans = [split(s, t) for s in b[text].tolist()]
            flat = np.asarray([x for one in spans for x in one], np.int32).reshape(-1, 2)
            yield pd.DataFrame({key: b[key].repeat([len(one) for one in spans]).to_numpy(), "start_pos": flat[:, 0], "end_pos": flat[:, 1]})

    return spread(docs.where(F.col(text).isNotNull()).select(key, text)).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, start_pos int, end_pos int")
