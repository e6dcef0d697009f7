"""Page boilerplate mixed with main content: consensus paths per host.

A page's containers are its lines, in the blocks that blank lines part. Each gets a generalised path: its part of the
page (before, among or after the running prose), the make of its block (links, entries, short lines, prose, mixed), its
own kind (heading, table, paragraph, list item, link, crumb, attributed comment, short line ...) and the masked template
of its text. Containers are scored on each page: running prose scores high, link lists, short lines and blocks around
them low. The scores are votes on the path, pooled in Spark per host and over all hosts, copies of a page counting once;
sentences that prose is made of anywhere count as prose wherever they stand, and prose that a host repeats on its pages
doesn't. Pages are then read again by the winning paths: a line stays if its path won. The documents of a context take
part with the host of the article that their title names.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.session import cut_lineage, if_small, spread

PRIOR = 3.0  # weight of the vote over all hosts against a host's own votes
TITLE_LEAST, TITLE_SHARE = 5, 0.001  # a short line that so many different texts, as a share of all pages, follow is no title
KNOWN_LEAST, KNOWN_SHARE = 2, 0.00001  # times that a sentence template stands in running prose, as a share of all pages, to be known
REPEAT_LEAST, REPEAT_SHARE = 3, 0.3  # different pages of a host, as a share of them, that prose stands on to be furniture
KNOWN = 0.34  # share of a line's sentences that must be known prose
PROSE_SENTENCES, PROSE_CHARS = 3, 120  # a line with as many sentences and characters scores as running prose

SENT = re.compile(r"(?<=[.!?…。！？।؟])[\"”’“»)\]]*(?:\[\d+\])?\s+|(?<=[。！？])[”」』]?")
TERM = re.compile(r"[.!?…。！？।؟][\"”’“»)\]」』]*(?:\s?»)?(?:\s?\[\d+\])*$")
BULLET = re.compile(r"^(?:[-*•»›·–]|\d{1,2}[.)])\s+")
LINK = re.compile(r"^\s*(?:[-*•]\s+)?\[[^\]]*\]\([^)]*\)\s*$")
HEADING = re.compile(r"^\s*(?:#{1,6}\s|\*\*Document Title\*\*: |\*(?:[Ss]ub)*[Ss]ection\*: )")
SEPARATOR = re.compile(r"^\s*(?:=={4,}=*|\*\*Document \d+\*\*:)\s*$")
CRUMB = re.compile(r"\s(?:>|»|\||/|·|•|::)\s")
ATTRIBUTED = re.compile(r"^(?:@\w+\s|[A-ZÀ-Þ]\w+(?:\s[A-ZÀ-Þ]\w+)?,\s\d{4}:\s|[A-ZÀ-Þ]\w+(?:\s[A-ZÀ-Þ]\w+)?\s(?:wrote|writes|said|schrieb|a écrit|écrit|escribió)\s?:\s)")
NOTICE = re.compile(r"^(?:©|\(c\)\s|copyright\b)", re.I)
NAME = re.compile(r"[A-ZÀ-Þ][^\W\d_]*")
DIGITS = re.compile(r"\d+")
WIDE = re.compile("[぀-ヿ㐀-鿿฀-๿]")
DOCUMENT = re.compile(r"^\*\*Document \d+\*\*:\s*$")


def crc(s: str) -> int:
    b = s.encode()
    return (zlib.crc32(b) << 31) ^ zlib.adler32(b)


def sentence_key(s: str) -> int:
    """What is left of a sentence without names, numbers and its first word: its template."""
    s = s.strip().rstrip(".!?…。！？।؟\"”’“»)] ")
    if not s.isascii() and WIDE.search(s):
        return crc(DIGITS.sub("9", s)[-4:])  # no blanks part words here: the predicate stands at the end
    w = s.split()
    if len(w) < 2:
        return crc(DIGITS.sub("9", s).lower())
    return crc(NAME.sub("N", DIGITS.sub("9", " ".join((*w[1:4], "~", w[-1])))))


def kind_of(line: str) -> tuple[str, str]:
    """(kind, the text without its marker)."""
    first = line[0]
    if first in "=*" and SEPARATOR.match(line):
        return "sep", line
    if first in "#*" and HEADING.match(line):
        return "heading", line
    if first == "|" and line.endswith("|") and len(line) > 1:
        return "table", line
    if first in "[-*•" and LINK.match(line):
        return "link", line
    if ATTRIBUTED.match(line):
        return "attributed", line
    if NOTICE.match(line):
        return "notice", line
    m = BULLET.match(line)
    text = line[m.end() :] if m else line
    ended = bool(TERM.search(text))
    many = len(text.split()) >= 4 or bool(WIDE.search(text))
    if not m and not ended and CRUMB.search(text) and max(len(x.split()) for x in CRUMB.split(text)) <= 4:
        return "crumb", text
    prose = (ended and (many or text[:1].isupper())) or (many and len(text) >= PROSE_CHARS)
    if m:
        return ("item" if prose else "entry"), text
    return ("line" if prose else "short"), text


LOW = {"link", "crumb", "entry", "short", "notice", "attributed"}


def make_of(kinds: list[str]) -> str:
    """What a block is made of."""
    for name, group in (("links", {"link"}), ("entries", {"entry", "link"}), ("shorts", {"short", "crumb", "notice"}), ("prose", {"line", "item"}), ("rows", {"table", "sep", "heading"})):
        if group.issuperset(kinds):
            return name
    return "mixed"


def containers(text: str, titles: set[str]) -> list[tuple[int, str, int, list[int], float, int]]:
    """(line_no, kind, path, sentence keys, score, hash of the prose that follows) of every line that isn't blank. The
    path of running prose is the hash of its text, so that only a repetition of the very line speaks against it."""
    out = []
    lines = [x.strip() for x in text.replace("\xa0", " ").split("\n")]
    kinds = [kind_of(x) if x else ("", "") for x in lines]
    n = len(lines)
    parts = [[s for s in SENT.split(t) if s and s.strip()] if k in ("line", "item") else [] for k, t in kinds]
    prose = [k == "line" and len(t) >= PROSE_CHARS and len(p) >= PROSE_SENTENCES for (k, t), p in zip(kinds, parts, strict=True)]
    following, last = [0] * n, 0
    ahead, more = [False] * n, False  # whether running prose follows in the same document
    for i in range(n - 1, -1, -1):
        if kinds[i][0] == "sep":
            last, more = 0, False
        following[i], ahead[i] = last, more
        more = more or prose[i]
        if prose[i] or (kinds[i][0] in ("line", "item") and len(kinds[i][1]) > 40):
            last = crc(lines[i])
    start, passed = 0, False
    while start < n:
        if not lines[start]:
            start += 1
            continue
        end = start
        while end < n and lines[end]:
            end += 1
        block = range(start, end)
        poor = sum(kinds[i][0] in LOW for i in block)
        make = make_of([kinds[i][0] for i in block])
        for i in block:
            kind, t = kinds[i]
            if DOCUMENT.match(lines[i]):
                passed = False
            where = "among" if passed and ahead[i] else "after" if passed else "before"
            keys: list[int] = []
            if kind in ("sep", "heading", "table"):
                mask, score = "", 1.0
            elif prose[i]:
                passed = True
                out.append((i + 1, "prose", crc(lines[i]), [sentence_key(s) for s in parts[i]], 1.0, following[i]))
                continue
            elif kind in ("line", "item"):
                keys = [sentence_key(s) for s in parts[i]]
                score = -0.5 if poor else 0.4 if where == "among" else -0.2  # at a page's edge prose is as likely as furniture
                if kind == "item" and not poor:
                    score = 0.6
                mask = ",".join(map(str, keys))
            elif kind == "short":
                mask = DIGITS.sub("9", t.lower())
                if t.lower() in titles:
                    kind, score = "title", 1.0
                elif end - start == 1 and not passed and t[:1].isupper() and not DIGITS.search(t) and all(w[:1].isupper() or len(w) < 4 for w in t.split()):
                    kind, score = "title?", 0.5
                else:
                    score = -0.7
            else:
                mask = DIGITS.sub("9", NAME.sub("N", t)) if kind == "notice" else ""
                score = -0.7 if kind == "entry" else -1.0
            # a masked text tells more than its place; a line that may be a title has the path of the short line that it is
            place = "short" if kind in ("short", "title", "title?") else kind if kind in ("line", "item") else f"{where}/{make}/{kind}"
            out.append((i + 1, kind, crc(f"{place}|{mask}"), keys, score, following[i]))
        start = end
    return out


LINE = "struct<line_no: int, kind: string, path: bigint, keys: array<bigint>, score: double, next: bigint>"
SCHEMA = f"place string, item_key string, host string, page bigint, lines array<{LINE}>"
TITLE = re.compile(r"^\s*(?:#{1,6}\s|\*\*Document Title\*\*: )?\s*(.*?)\s*$")


def documents(text: str, hosts: dict[str, str]) -> list[tuple[int, str]]:
    """(first line, host) of the documents of a page: a text without document labels is one."""
    out, seen = [(1, "")], False
    for i, line in enumerate(text.split("\n"), 1):
        if DOCUMENT.match(line.strip()):
            out.append((i, ""))
            seen = False
        elif not seen and (h := hosts.get(TITLE.match(line).group(1).lower())):
            out[-1] = (out[-1][0], h)
            seen = True
    return out


def scored(pages: DataFrame) -> DataFrame:
    """The documents of every page, with their lines as scored containers, and `page`, a hash of their running prose.

    pages: place, item_key, host, titles (JSON array of title and host), text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for place, item, host, titles, text in zip(*(b[c].tolist() for c in ("place", "item_key", "host", "titles", "text")), strict=True):
                hosts = {t["title"].strip().lower(): t.get("host") or "" for t in json.loads(titles or "[]") if t.get("title")}
                found = containers(text, set(hosts))
                starts = documents(text, hosts) if place == "context" else [(1, host)]
                for (a, h), (z, _) in zip(starts, [*starts[1:], (1 << 31, "")], strict=True):
                    own = [x for x in found if a <= x[0] < z]
                    if own:
                        said = ",".join(str(x[2]) for x in own if x[1] == "prose")
                        out.append((place, item, h, crc(said), [dict(zip(("line_no", "kind", "path", "keys", "score", "next"), x, strict=True)) for x in own]))
            yield pd.DataFrame(out, columns=["place", "item_key", "host", "page", "lines"])

    return spread(pages.where(F.col("text").isNotNull())).mapInPandas(run, SCHEMA)


def furniture_lines(pages: DataFrame) -> DataFrame:
    """(place, item_key, line_no) of every non-blank line that isn't main body.

    pages: place, item_key, host, titles, text. Null and empty texts have no lines. A line is split off at LF and counted
    from 1. Pages without a host, or alone on theirs, are judged by the votes over all hosts. Repeated pages come out
    each, but a repeated line votes once for the prose that follows it. The result doesn't depend on the order of rows.
    """
    named = F.when(F.col("host") == "", 0).otherwise(F.xxhash64("host"))  # 0: no host
    docs = cut_lineage(scored(pages).withColumn("host", named))  # one row per document; the pages are read once
    n_pages = docs.count()
    lines = docs.select("place", "item_key", "host", "page", F.explode("lines").alias("l")).select("place", "item_key", "host", "page", "l.*")
    prose, other = lines.where("kind = 'prose'"), lines.where("kind <> 'prose'")
    votes = other.groupBy("host", "path", "next").agg(F.avg("score").alias("score"), F.max(F.col("kind").isin("title?", "short", "title").cast("int")).alias("short"))
    by_host = votes.groupBy("host", "path").agg(F.sum("score").alias("hs"), F.count("*").alias("hn"))
    by_path = votes.groupBy("path").agg(F.sum("score").alias("gs"), F.count("*").alias("gn"), F.count_distinct(F.when(F.col("short") == 1, F.col("next"))).alias("n_next"))
    j = other.drop("page", "next").join(if_small(by_path), "path", "left").join(if_small(by_host.where("host <> 0 and hn > 1")), ["host", "path"], "left")
    vote = (F.coalesce("hs", F.lit(0.0)) + PRIOR * F.col("gs") / F.col("gn")) / (F.coalesce("hn", F.lit(0)) + PRIOR)
    main = F.when(F.col("kind") == "title", True).when(F.col("kind") == "title?", F.col("n_next") < max(TITLE_LEAST, TITLE_SHARE * n_pages)).otherwise(0.5 * F.col("score") + vote > 0)
    lost = j.where(~main)
    # lines that lost may still be made of sentences that running prose is made of
    known = prose.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= max(KNOWN_LEAST, KNOWN_SHARE * n_pages)).select("key")
    loose = lost.where(F.col("kind").isin("line", "item")).select("place", "item_key", "line_no", F.size("keys").alias("n_keys"), F.explode("keys").alias("key"))
    saved = loose.join(if_small(known), "key", "left_semi").groupBy("place", "item_key", "line_no", "n_keys").agg(F.count("*").alias("n")).where(F.col("n") >= F.greatest(F.lit(1.0), F.col("n_keys") * KNOWN))
    out = lost.select("place", "item_key", "line_no", "kind")
    out = out.where(~F.col("kind").isin("line", "item")).unionByName(out.where(F.col("kind").isin("line", "item")).join(saved, ["place", "item_key", "line_no"], "left_anti").select(out.columns))
    # prose that a host carries on many of its pages
    host_pages = docs.where("host <> 0").groupBy("host").agg(F.count_distinct("page").alias("pages"))
    carried = prose.where("host <> 0").groupBy("host", "path").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= REPEAT_LEAST)
    carried = carried.join(if_small(host_pages), "host").where(F.col("n") >= REPEAT_SHARE * F.col("pages")).select("host", "path")
    return out.drop("kind").unionByName(prose.join(if_small(carried), ["host", "path"], "left_semi").select("place", "item_key", "line_no"))


def article_pages(articles: DataFrame) -> DataFrame:
    host = F.coalesce("site", F.lit(""))
    return articles.select(F.lit("article").alias("place"), F.col("basename").alias("item_key"), host.alias("host"), F.to_json(F.array(F.struct("title", host.alias("host")))).alias("titles"), F.col("page_text").alias("text"))


def context_pages(samples: DataFrame, articles: DataFrame) -> DataFrame:
    """Contexts with the titles and hosts of the articles that they name."""
    named = samples.select("sample_id", F.explode("relevant_web_articles").alias("basename"))
    known = articles.where("title is not null").select("basename", "title", F.coalesce("site", F.lit("")).alias("host"))
    titles = named.join(known, "basename").groupBy("sample_id").agg(F.to_json(F.array_sort(F.collect_set(F.struct("title", "host")))).alias("titles"))  # as many as a sample names
    c = samples.select("sample_id", F.col("context").alias("text")).join(if_small(titles), "sample_id", "left")
    return c.select(F.lit("context").alias("place"), F.col("sample_id").cast("string").alias("item_key"), F.lit("").alias("host"), "titles", "text")


def main_bodies(pages: DataFrame) -> DataFrame:
    """(place, item_key, body): every page's text without its furniture lines."""
    cut = furniture_lines(pages).groupBy("place", "item_key").agg(F.collect_list("line_no").alias("cut"))
    keep = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).alias("i"), x.alias("x"))), lambda s: ~F.array_contains(F.coalesce(F.col("cut"), F.array().cast("array<int>")), s["i"]))
    return pages.join(cut, ["place", "item_key"], "left").select("place", "item_key", F.array_join(F.transform(keep, lambda s: s["x"]), "\n").alias("body"))
