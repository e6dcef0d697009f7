"""Text expressions of the pipeline, all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Words that a question may not contain, in the order they are looked for.
AVOID_KEYWORDS = ["list", "table", "column", "row", "field", "section", "caption", "metadata", "dataframe", "markdown", "html", "json", "sql", "python", "this"]
# Words without weight in a search, of the languages that questions are asked in.
STOPWORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with "
    "from had has have he her his how its many name named near one some were what when where which while who within "
    "der die das den dem des ein eine und im am an auf aus bei für mit nach von vor wie wurde zu "
    "le la les de du des un une et à au aux en dans par pour que qui sur fut "
    "el los las del al y con por para que se una un en su fue"
).split()
# Link prefixes that lead to no article.
NON_ARTICLE = ["/wiki/Special:", "/wiki/Help:", "/wiki/Wikipedia:", "/wiki/Talk:", "/wiki/File:", "/wiki/Category:", "/wiki/Portal:", "/wiki/Template:"]
# Words for a missing cell.
NULLISH = ["none", "nan", "na", "n/a", ""]
# Traces of generated steps, removed in this order.
STEP_ARTEFACTS = [
    "Purpose and action in natural language:",
    "**Purpose and action in natural language:**",
    "Corresponding code snippet:",
    "**Corresponding code snippet:**",
    "The corresponding code snippet to support the logic:",
]
# Phrases that become one introduction, in this order.
STEP_PHRASES = ["Resulting intermediate variable:", "Resulting intermediate variables:", "**The resulting intermediate variable:**"]
STEP_INTRODUCTION = "The intermediate result is:\n"
# Line forms of the second generation of traces.
LINE_ARTEFACTS = ["purpose and action in natural language", "corresponding code snippet"]
LINE_PHRASE = "intermediate variable"
# Repairs of malformed section markers, applied once each in this order.
MARKER_REPAIRS = [("[[##", "[[ ##"), ("##]]", "## ]]"), ("[[# ", "[[ ##"), (" #]]", "## ]]")]


def c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def href_to_title(href: ColumnOrName) -> Column:
    """The article title a link leads to, or null: not an article path, an excluded namespace, or empty.

    Escapes are decoded before the fragment is cut off; a plus sign stays, and a bad escape leaves the text as it is.
    """
    h = c(href)
    raw = h.substr(F.lit(7), F.char_length(h))
    decoded = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
    title = F.split(F.replace(decoded, F.lit("_"), F.lit(" ")), "#", 2)[0]
    excluded = F.lit(False)
    for p in NON_ARTICLE:
        excluded = excluded | h.startswith(p)
    return F.when(h.startswith("/wiki/") & ~excluded & (title != ""), title)


def url_key(url: ColumnOrName) -> Column:
    """A file-safe key: everything but ASCII letters and digits becomes a dash, at most 246 characters."""
    return F.substring(F.regexp_replace(c(url), "[^a-zA-Z0-9]", "-"), 1, 246)


def first_keyword(text: ColumnOrName, keywords: list[str] = AVOID_KEYWORDS) -> Column:
    """The first keyword of the list that occurs in the text as a substring, case ignored; null if none does."""
    low = F.lower(c(text))
    out = F.lit(None).cast("string")
    for k in reversed(keywords):
        out = F.when(F.contains(low, F.lit(k)), k).otherwise(out)
    return out


def nullish(text: ColumnOrName) -> Column:
    return c(text).isNull() | F.lower(F.trim(c(text))).isin(NULLISH)


def truthy(text: ColumnOrName) -> Column:
    return F.coalesce(c(text), F.lit("")) != ""


def word_count(text: ColumnOrName) -> Column:
    """Tokens of the default tokenizer: runs without white space."""
    return F.size(F.array_remove(F.split(F.coalesce(c(text), F.lit("")), r"\s+"), ""))


def clean_steps(trace: ColumnOrName) -> Column:
    """First cleaner: code fences, step artefacts and phrases, then runs of blank lines, then the ends."""
    t = F.regexp_replace(c(trace), r"(?s)```python.*?```", "")
    for a in STEP_ARTEFACTS:
        t = F.replace(t, F.lit(a), F.lit(""))
    for p in STEP_PHRASES:
        t = F.replace(t, F.lit(p), F.lit(STEP_INTRODUCTION))
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def clean_lines(trace: ColumnOrName) -> Column:
    """Second cleaner, line by line and case ignored: code fences and artefact lines go, phrase lines become the
    introduction, then runs of blank lines and the ends as in the first; '' for null."""
    lines = F.split(F.regexp_replace(F.coalesce(c(trace), F.lit("")), r"(?s)```python.*?```", ""), r"\r\n|\n|\r")
    kept = F.filter(lines, lambda x: ~F.exists(F.array(*map(F.lit, LINE_ARTEFACTS)), lambda a: F.contains(F.lower(x), a)))
    said = F.transform(kept, lambda x: F.when(F.contains(F.lower(x), F.lit(LINE_PHRASE)), F.lit(STEP_INTRODUCTION.strip())).otherwise(x))
    return F.regexp_replace(F.regexp_replace(F.array_join(said, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def strip_tags(text: ColumnOrName) -> Column:
    return F.regexp_replace(c(text), "<[^>]+>", "")


def neutral_headings(text: ColumnOrName) -> Column:
    """Heading markers as words: a line's first run of # at its start names the level, and every such run in it is replaced."""

    def one(line: Column) -> Column:
        marks = F.regexp_extract(F.trim(line), r"^(#+)", 1)
        n = F.char_length(marks)
        word = F.concat(F.repeat(F.lit("sub"), F.greatest(n - 2, F.lit(0))), F.lit("section"))
        name = F.when(n == 1, F.lit("**Document Title**: ")).otherwise(F.concat(F.lit("*S"), F.substring(word, 2, 100_000), F.lit("*: ")))
        return F.when(n > 0, F.replace(line, marks, name)).otherwise(line)

    return F.array_join(F.transform(F.split(c(text), "\n"), one), "\n")


def section_of(markdown: ColumnOrName, title: str) -> Column:
    """The text under the first heading that begins with title, case ignored, up to the next heading; null if absent."""
    import re

    rx = rf"(?is)#+\s*{re.escape(title)}\s*(.*?)(?:\n#|\z)"
    return F.when(c(markdown).rlike(rf"(?is)#+\s*{re.escape(title)}"), F.regexp_extract(c(markdown), rx, 1))


def last_path_part(path: ColumnOrName) -> Column:
    return F.element_at(F.split(c(path), " / "), -1)


def split_around(page: ColumnOrName, section: ColumnOrName) -> Column:
    """(before, after) of the first occurrence of a section in a page; the whole page and '' without one."""
    at = F.instr(c(page), c(section))
    return F.struct(
        F.when(at > 0, F.left(c(page), at - 1)).otherwise(c(page)).alias("before"),
        F.when(at > 0, c(page).substr(at + F.char_length(c(section)), F.char_length(c(page)))).otherwise("").alias("after"),
    )


def must_keep(page: ColumnOrName, window: int = 10_000) -> Column:
    """The lead of a page: what stands before the first blank line of its first window characters."""
    return F.substring_index(F.substring(c(page), 1, window), "\n\n", 1)


def fenced(text: ColumnOrName, language: str) -> Column:
    """The content of the first code fence of that language, trimmed; the text itself without one."""
    rx = rf"(?s)```{language}(.*?)```"
    return F.when(c(text).rlike(rx), F.trim(F.regexp_replace(F.regexp_extract(c(text), rx, 1), r"^\s+|\s+$", ""))).otherwise(c(text))


def repair_markers(text: ColumnOrName) -> Column:
    t = c(text)
    for a, b in MARKER_REPAIRS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def fill(template: ColumnOrName, values: ColumnOrName) -> Column:
    """{name} placeholders replaced by a map's values; unknown names stay."""
    pairs = F.map_entries(F.coalesce(c(values), F.create_map().cast("map<string,string>")))
    return F.aggregate(pairs, c(template), lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))


def json_text(value: ColumnOrName, fields: list[str] | None = None) -> Column:
    """A list, or a map's or struct's named values, as JSON indented by 2; '[]' for an empty list."""
    if fields is None:
        items = F.transform(c(value), lambda x: F.get_json_object(F.to_json(F.array(x)), "$"))
        items = F.transform(items, lambda x: F.concat(F.lit("  "), F.substring(x, F.lit(2), F.char_length(x) - 2)))
        return F.when(F.size(c(value)) > 0, F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit("\n]"))).otherwise(F.when(c(value).isNotNull(), "[]"))
    quoted = lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")
    pairs = [F.concat(F.lit(f'  "{f}": '), F.coalesce(F.nullif(quoted(c(value)[f]), F.lit("")), F.lit("null"))) for f in fields]
    return F.when(c(value).isNotNull(), F.concat(F.lit("{\n"), F.concat_ws(",\n", *pairs), F.lit("\n}")))


def fill_all(template: ColumnOrName, values: ColumnOrName) -> Column:
    """fill() of a whole trace: the raw text if a placeholder has no value or a brace stands alone."""
    names = F.array_distinct(F.regexp_extract_all(c(template), F.lit(r"\{(\w+)\}"), 1))
    stray = F.regexp_replace(c(template), r"\{\w+\}", "").rlike(r"[{}]")
    return F.when(stray | ~F.forall(names, lambda x: F.map_contains_key(c(values), x)), c(template)).otherwise(fill(template, values))


def first_missing(fields: list[str]) -> Column:
    """The first required field that is null or empty; null if all are there."""
    return F.coalesce(*(F.when(~truthy(F.col(f).cast("string")), f) for f in fields))


# What is said around the table, the reasoning and the answer of a sample.
TABLE_INTRODUCTION = "To answer this question, I first aggregate the key information from the documents into a structured table:\n\n"
REASONING_INTRODUCTION = "\n\nNow I'll work through the solution step by step:\n\n"
ANSWER_INTRODUCTION = "Based on the analysis, the answer is:\n\n"


def thinking(table: ColumnOrName, trace: ColumnOrName) -> Column:
    """The reasoning of a sample: its table, then its trace."""
    return F.concat(F.lit(TABLE_INTRODUCTION), c(table), F.lit(REASONING_INTRODUCTION), c(trace))


def output(answer: ColumnOrName) -> Column:
    """The answer of a sample; a missing one is written None."""
    return F.concat(F.lit(ANSWER_INTRODUCTION), F.coalesce(c(answer), F.lit("None")))


def document_list(texts: ColumnOrName) -> Column:
    """Numbered documents: line breaks and blanks run together, tags dropped, a heading for each."""
    return F.array_join(F.transform(c(texts), lambda d, i: F.concat(F.lit("**Document "), (i + 1).cast("string"), F.lit("**:\n"), strip_tags(F.regexp_replace(d, r"[\n ]+", " ")))), "\n\n")


def narrate(context: ColumnOrName, question: ColumnOrName) -> Column:
    """The input of a sample: its documents, the question and the scope note."""
    return F.concat(F.lit("Given the following documents:\n\n"), c(context), F.lit("\n\nQuestion: "), c(question), F.lit("\n(Please answer within the scope of the given documents.)"))


def messages(user: ColumnOrName, assistant: ColumnOrName) -> Column:
    """A chat as an array of (role, content); an empty turn is left out."""
    turn = lambda role, x: F.struct(F.lit(role).alias("role"), c(x).alias("content"))
    return F.filter(F.array(turn("user", user), turn("assistant", assistant)), lambda m: F.coalesce(m["content"], F.lit("")) != "")
