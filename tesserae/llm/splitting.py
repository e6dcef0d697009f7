"""Splitting oversized items at natural boundaries, in ranges with halos.

A text or file is read in ranges of fixed size. Each worker finds the boundaries that start in its range, looking a halo
beyond both ends, and adds them to a boundary table; range lengths are summed up to offsets, boundary tables are stitched
over those, and pieces are chosen from boundaries alone. Pieces are emitted by offset, so nothing loads a whole file.
Boundaries, best first: paragraph (blank lines), line (LF or CRLF), space (runs of blanks), none (anywhere).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.session import cut_lineage, spread

LIMIT, OVERLAP = 4000, 200
RANGE = 1 << 16  # characters of a range of a text
HALO = 1 << 10  # characters read beyond a range's ends, or as many more as a run of blanks there has
SEGMENT = 1 << 20  # characters over which pieces are chosen one after another; a longer text is cut at the best boundary before each multiple first
FILE_RANGE = 8 << 20  # bytes of a range of a file
KINDS = ["paragraph", "line", "space", "none"]

PARAGRAPH = re.compile(r"\r?\n(?:[ \t\r]*\n)+")
LINE = re.compile(r"\r?\n")
SPACE = re.compile(r"[ \t\r\n]+")
PATTERNS = [PARAGRAPH, LINE, SPACE]


def gaps(text: str, start: int, end: int, rx: re.Pattern) -> tuple[int, int, int]:
    """(characters before the first boundary that starts in [start, end), longest stretch between two, characters after
    the last), counted within the range; with no boundary the first is -1 and the others are the range's length."""
    first, best, at = -1, 0, start
    m = rx.search(text)
    while m and m.end() <= start:
        m = rx.search(text, m.end())
    if m and m.start() < start:  # a run that began in the range before: what it covers here is no stretch
        at = min(m.end(), end)
        first, m = 0, rx.search(text, m.end())
    while m and m.start() < end:
        if first < 0:
            first = m.start() - start
        else:
            best = max(best, m.start() - at)
        at = min(m.end(), end)
        m = rx.search(text, m.end())
    if first < 0:
        return -1, end - start, end - start
    return first, best, end - at


BLANKS = " \t\r\n"


def ranges(df: DataFrame, key: str, text: str, size: int = RANGE, halo: int = HALO) -> DataFrame:
    """(key, n, part, before, chars, t): each text's ranges with their halos; n is the text's length, part counts from 0,
    before and chars are the characters of the leading halo and of the range itself. Halos reach beyond runs of blanks."""
    n = F.char_length(text)
    s = df.where(F.col(text).isNotNull()).select(key, F.col(text).alias("_t"), n.alias("n"), F.posexplode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size))).alias("part", "_s"))
    head, rest = F.left(F.col("_t"), F.col("_s")), F.col("_t").substr(F.col("_s") + size + 1, F.col("n"))
    lead = F.greatest(F.char_length(head) - F.char_length(F.rtrim(head, F.lit(BLANKS))) + 2, F.lit(halo))
    after = F.greatest(F.char_length(rest) - F.char_length(F.ltrim(rest, F.lit(BLANKS))) + 2, F.lit(halo))
    one = F.col("n") <= size
    a = F.when(one, 0).otherwise(F.greatest(F.col("_s") - lead, F.lit(0))).cast("int")
    s = s.withColumn("_a", a).withColumn("_z", F.when(one, F.col("n")).otherwise(F.col("_s") + size + after).cast("int"))
    whole = F.when(one, F.col("_t")).otherwise(F.col("_t").substr(F.col("_a") + 1, F.col("_z") - F.col("_a")))
    return s.select(key, "n", "part", (F.col("_s") - F.col("_a")).alias("before"), F.least(F.lit(size), F.col("n") - F.col("_s")).alias("chars"), whole.alias("t"))


def sufficient_boundary(df: DataFrame, key: str, text: str, limit: int = LIMIT) -> DataFrame:
    """(key, boundary) of every text longer than limit: the first kind of boundary that leaves no stretch over limit.

    Null and shorter texts give no row; equal texts under other keys give one each; an empty table gives none.
    """
    kind = dict(df.dtypes)[key]
    long = df.where(F.char_length(text) > limit)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, n, part, before, chars, t in zip(*(b[c].tolist() for c in (key, "n", "part", "before", "chars", "t")), strict=True):
                for level, rx in enumerate(PATTERNS):
                    f, g, z = gaps(t, before, before + chars, rx)
                    out.append((k, n, part, chars, level, f, g, z))
                    if n == chars and max(f, g, z) <= limit and f >= 0:
                        break  # the only range, and this kind suffices
            yield pd.DataFrame(out, columns=[key, "n", "part", "chars", "level", "first", "inner", "last"])

    table = ranges(long, key, text).mapInPandas(measure, f"{key} {kind}, n int, part int, chars int, level int, first int, inner int, last int")
    # stitch: the open stretch that reaches a range is what the ranges since the last boundary leave
    w = Window.partitionBy(key, "level").orderBy("part")
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("chars").over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = table.withColumn("end", total).withColumn("open", F.when(F.col("first") >= 0, F.col("end") - F.col("last")))
    s = s.withColumn("from", F.coalesce(F.last("open", ignorenulls=True).over(upto), F.lit(0)))
    reach = F.when(F.col("first") >= 0, F.greatest(F.col("end") - F.col("chars") + F.col("first") - F.col("from"), F.col("inner"), F.col("last"))).otherwise(F.col("end") - F.col("from"))
    worst = s.withColumn("worst", reach).groupBy(key, "level").agg(F.max("worst").alias("worst"))
    best = worst.groupBy(key).agg(F.min(F.when(F.col("worst") <= limit, F.col("level"))).alias("level"))
    return best.select(key, F.element_at(F.array(*map(F.lit, KINDS)), F.coalesce(F.col("level"), F.lit(3)) + 1).alias("boundary"))


def cut_points(text: str, start: int, end: int, limit: int) -> list[tuple[int, int]]:
    """(offset after the boundary, level) of boundaries that start in [start, end): all paragraphs and lines, and in
    stretches without one the spaces, thinned to those that a cut could use."""
    out: list[tuple[int, int]] = []
    at = start
    marks: list[tuple[int, int, int]] = []
    for m in LINE.finditer(text, start, min(len(text), end)):
        p = PARAGRAPH.match(text, m.start())
        marks.append((m.start(), p.end() if p else m.end(), 0 if p else 1))
    at = start
    for a, b, level in [*marks, (end, end, 3)]:
        if a - at > limit // 8:  # a long line: spaces inside it, one in every stretch of a 40th of the limit
            step, nxt = max(1, limit // 40), at
            for m in SPACE.finditer(text, at, a):
                if m.end() >= nxt:
                    out.append((m.end(), 2))
                    nxt = m.end() + step
        if level < 3 and b > at:
            if not (out and out[-1][0] >= b):
                out.append((b, level))
            at = b
    return out


def choose(cuts: list[tuple[int, int]], begin: int, end: int, limit: int, overlap: int, last: int = 0) -> list[tuple[int, int, int]]:
    """Greedy pieces (start, end, level of the cut at its end) of [begin, end): each at most limit long, each starting
    overlap before the end of the one before. A paragraph end is taken if the piece is then at least half full, else a
    line end likewise, else any boundary, else the limit itself. last is the level of the boundary at the end."""
    offsets = [c[0] for c in cuts]
    out, start = [], begin
    while end - start > limit:
        lo, hi = start + overlap + 1, start + limit
        i, j = bisect_right(offsets, lo), bisect_right(offsets, hi)
        pick = None
        for level, least in ((0, limit // 2), (1, limit // 2), (2, limit // 2), (0, 0), (1, 0), (2, 0)):
            for k in range(j - 1, i - 1, -1):
                if offsets[k] - start < least:
                    break
                if cuts[k][1] == level:
                    pick = cuts[k]
                    break
            if pick:
                break
        cut, level = pick or (hi, 3)
        out.append((start, cut, level))
        start = cut - overlap
    out.append((start, end, last))
    return out


def piece_offsets(table: DataFrame, key: str, limit: int, overlap: int) -> DataFrame:
    """(key, piece, start, end, boundary) from the stitched boundary table (key, n, part, seg, cuts): segment by segment.

    A segment ends at the best boundary among the last limit characters before its multiple of SEGMENT, and what lies
    behind that goes to the next one.
    """
    kind = dict(table.dtypes)[key]
    segs = table.groupBy(key, "seg").agg(F.max("n").alias("n"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "cuts"))), lambda x: x["cuts"])).alias("cuts"))
    mark = (F.col("seg").cast("bigint") + 1) * SEGMENT
    near = F.filter("cuts", lambda c: (c["at"] > mark - limit) & (c["at"] <= mark))
    best = F.coalesce(F.array_min(F.transform(near, lambda c: F.struct(c["level"].alias("level"), (-c["at"]).alias("at")))), F.struct(F.lit(3).alias("level"), (-mark).alias("at")))
    segs = segs.withColumn("_e", F.when(mark >= F.col("n"), F.struct(F.lit(0).alias("level"), (-F.col("n")).alias("at"))).otherwise(best))
    segs = segs.select(key, "seg", "n", "cuts", (-F.col("_e.at")).alias("edge"), F.col("_e.level").alias("level"))
    prior = segs.select(F.col(key), (F.col("seg") + 1).alias("seg"), F.col("edge").alias("begin"), F.filter("cuts", lambda c: c["at"] > F.col("edge")).alias("carried"))
    both = segs.join(prior, [key, "seg"], "left").select(key, "seg", "n", "edge", "level", F.coalesce("begin", F.lit(0)).alias("begin"), F.concat(F.coalesce("carried", F.array().cast(dict(segs.dtypes)["cuts"])), F.filter("cuts", lambda c: c["at"] <= F.col("edge"))).alias("cuts"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, seg, n, edge, level, begin, t in zip(*(b[c].tolist() for c in (key, "seg", "n", "edge", "level", "begin", "cuts")), strict=True):
                least: dict[int, int] = {}
                for c in t:  # a run of blanks across two ranges is in both
                    least[c["at"]] = min(least.get(c["at"], 3), c["level"])
                first = begin if seg == 0 else begin - overlap
                chosen = choose(sorted(least.items()), first, edge, limit, overlap, level)
                out.append((k, seg, [{"start": a, "end": z, "boundary": KINDS[v] if z < n else "end"} for a, z, v in chosen]))
            yield pd.DataFrame(out, columns=[key, "seg", "p"])

    got = both.mapInPandas(pick, f"{key} {kind}, seg int, p array<struct<start: bigint, end: bigint, boundary: string>>")
    # pieces are numbered by the sum of the segments before, so a key's pieces never meet in one task, only its segments
    before = F.coalesce(F.sum(F.size("p")).over(Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    got = got.withColumn("_before", before).select(key, "_before", F.posexplode("p").alias("_i", "_p"))
    return got.select(key, (F.col("_before") + F.col("_i")).cast("int").alias("piece"), "_p.start", "_p.end", "_p.boundary")


def joined(bits: DataFrame, key: str) -> DataFrame:
    """Pieces from the parts of them that were emitted range by range."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "t"))), lambda x: x["t"]), "")
    return bits.groupBy(key, "piece", "start", "end", "boundary").agg(whole.alias("text"))


def split_texts(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, piece, start, end, boundary, text): the pieces of every text longer than limit, in order.

    Joined without their overlaps the pieces give the text back. Keys must be unique; null and short texts give no row.
    A text of one range is read, cut and emitted at once; of a longer one every range is read alone for its boundaries
    and again for its pieces, both by the same choice.
    """
    kind = dict(df.dtypes)[key]
    long = df.where(F.char_length(text) > limit).select(key, text)
    out_schema = f"{key} {kind}, piece int, start bigint, end bigint, boundary string, text string"

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t in zip(b[key].tolist(), b[text].tolist(), strict=True):
                n = len(t)
                chosen = choose(cut_points(t, 0, n, limit), 0, n, limit, overlap)
                out += [(k, i, a, z, KINDS[v] if z < n else "end", t[a:z]) for i, (a, z, v) in enumerate(chosen)]
            yield pd.DataFrame(out, columns=[key, "piece", "start", "end", "boundary", "text"])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, n, part, before, chars, t in zip(*(b[c].tolist() for c in (key, "n", "part", "before", "chars", "t")), strict=True):
                base = part * RANGE - before
                by: dict[int, list[dict]] = {part * RANGE // SEGMENT: []}
                for a, v in cut_points(t, before, before + chars, limit):
                    by.setdefault((base + a) // SEGMENT, []).append({"at": base + a, "level": v})
                out += [(k, n, part, seg, cuts) for seg, cuts in by.items() if seg * SEGMENT < n]
            yield pd.DataFrame(out, columns=[key, "n", "part", "seg", "cuts"])

    short = spread(long.where(F.char_length(text) <= RANGE)).mapInPandas(whole, out_schema)
    parts = ranges(long.where(F.char_length(text) > RANGE), key, text)
    table = parts.mapInPandas(find, f"{key} {kind}, n bigint, part int, seg int, cuts array<struct<at: bigint, level: int>>")
    offsets = piece_offsets(table, key, limit, overlap)
    touched = offsets.withColumn("part", F.explode(F.sequence(F.floor(F.col("start") / RANGE), F.floor((F.col("end") - 1) / RANGE)))).withColumn("part", F.col("part").cast("int"))
    jobs = touched.groupBy(key, "part").agg(F.collect_list(F.struct("piece", "start", "end", "boundary")).alias("p"))  # as many as a range holds

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, part, before, chars, t, p in zip(*(b[c].tolist() for c in (key, "part", "before", "chars", "t", "p")), strict=True):
                own, base = t[before : before + chars], part * RANGE
                rows += [(k, x["piece"], x["start"], x["end"], x["boundary"], part, own[max(0, x["start"] - base) : x["end"] - base]) for x in p]
            yield pd.DataFrame(rows, columns=[key, "piece", "start", "end", "boundary", "part", "t"])

    bits = parts.join(jobs, [key, "part"]).mapInPandas(emit, f"{key} {kind}, piece int, start bigint, end bigint, boundary string, part int, t string")
    return short.unionByName(joined(bits, key))


def open_at(path: str):  # noqa: ANN201
    """A seekable reader of a local or remote file."""
    import pyarrow.fs as pafs

    fs, p = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(p)


def whole_characters(f, a: int, z: int, size: int) -> bytes:  # noqa: ANN001
    """The bytes of the characters that start in [a, z) of a UTF-8 file."""
    f.seek(a)
    raw = f.read(min(size, z + 3) - a)
    i = 0
    while a > 0 and i < len(raw) and raw[i] & 0xC0 == 0x80:
        i += 1
    j = min(len(raw), z - a)
    while j < len(raw) and raw[j] & 0xC0 == 0x80:
        j += 1
    return raw[i:j]


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, file_range: int = FILE_RANGE) -> DataFrame:
    """(path, piece, start, end, boundary, text) of UTF-8 files of any size; start and end count characters.

    Every byte range is read alone: its characters are counted, the counts summed up to offsets, boundaries are found
    with a halo of the neighbouring ranges, and each piece's text is read from the ranges its offsets fall in.
    """
    sizes = [(p, open_at(p).size()) for p in paths]
    files = spark.createDataFrame(sizes, "path string, size bigint")
    rs = files.select("path", "size", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(file_range).cast("bigint"))).alias("part", "a"))
    rs = rs.repartition(max(1, min(2000, sum(s for _, s in sizes) // file_range + 1)), "path", "part")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, size, part, a in zip(*(b[c].tolist() for c in ("path", "size", "part", "a")), strict=True):
                with open_at(path) as f:
                    out.append((path, size, part, a, len(whole_characters(f, a, min(size, a + file_range), size).decode("utf-8", "replace"))))
            yield pd.DataFrame(out, columns=["path", "size", "part", "a", "chars"])

    c = rs.mapInPandas(count, "path string, size bigint, part int, a bigint, chars bigint")
    w = Window.partitionBy("path").orderBy("part")
    c = c.withColumn("base", F.coalesce(F.sum("chars").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    c = cut_lineage(c.withColumn("n", F.sum("chars").over(Window.partitionBy("path"))))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, size, part, a, chars, base, n in zip(*(b[x].tolist() for x in ("path", "size", "part", "a", "chars", "base", "n")), strict=True):
                with open_at(path) as f:
                    t = whole_characters(f, a, min(size, a + file_range + 4 * HALO), size).decode("utf-8", "replace")
                by: dict[int, list[dict]] = {}
                for at, v in cut_points(t, 0, chars, limit):
                    by.setdefault((base + at) // SEGMENT, []).append({"at": base + at, "level": v})
                for seg in range(base // SEGMENT, (base + max(chars, 1) - 1) // SEGMENT + 1):
                    out.append((path, n, part, seg, by.get(seg, [])))
            yield pd.DataFrame(out, columns=["path", "n", "part", "seg", "cuts"])

    table = c.mapInPandas(find, "path string, n bigint, part int, seg int, cuts array<struct<at: bigint, level: int>>")
    offsets = piece_offsets(table.where("n > 0"), "path", limit, overlap)
    # a piece goes to each range it touches, and the ranges' parts of it are put together in order
    touch = offsets.join(c, "path").where((F.col("start") < F.col("base") + F.col("chars")) & (F.col("end") > F.col("base")))
    jobs = touch.groupBy("path", "size", "part", "a", "base", "chars").agg(F.collect_list(F.struct("piece", "start", "end", "boundary")).alias("p"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, size, part, a, base, p in zip(*(b[x].tolist() for x in ("path", "size", "part", "a", "base", "p")), strict=True):
                with open_at(path) as f:
                    t = whole_characters(f, a, min(size, a + file_range), size).decode("utf-8", "replace")
                rows = [(path, x["piece"], x["start"], x["end"], x["boundary"], part, t[max(0, x["start"] - base) : x["end"] - base]) for x in p]
                yield pd.DataFrame(rows, columns=["path", "piece", "start", "end", "boundary", "part", "t"])

    bits = jobs.mapInPandas(emit, "path string, piece int, start bigint, end bigint, boundary string, part int, t string")
    return joined(bits, "path")
