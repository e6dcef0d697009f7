"""How a text ends: finished, or broken off in a word or sentence."""

from __future__ import annotations

import re

from tesserae.llm import linear

TAIL_CHARS = 400  # what is read of a text's end; a property of the last sentence, so no text is cut short by it

TERMINAL = ".!?。！？।؟۔｡॥"
CLOSERS = "\"'”’»“‘›)]）」』】*_`"
END_RE = re.compile(rf"[{re.escape(TERMINAL)}…][{re.escape(CLOSERS)}\s]*$")
#: Marks that a transfer or a field limit leaves behind the point where it cut.
MARK_RE = re.compile(r"(?:\s*(?:\.\.\.|…|\[\s*(?:\.\.\.|…|truncated|cut|cut off|snip|continued|more|gekürzt|tronqué|truncado)\s*\]|<\s*(?:truncated|cut|snip)\s*>|\((?:truncated|cut|cut off|continued)\)|�+|\\x[0-9a-fA-F]{0,2}|\\u[0-9a-fA-F]{0,3}|&[a-z#0-9]{0,6}|\\))+\s*$", re.I)
#: Abbreviations that stand inside a sentence, so their full stop ends none.
ABBREVIATIONS = set(
    "dr mr mrs ms prof capt lt col gen rev st mt no nos vol vols p pp fig figs eq eqs lot cf vs approx ca e.g i.e a.k.a al co ave "
    "sr sra srta dra pág ej núm m mme mlle ex z z.b b d d.h h u u.a abb bez bd nr str bzw vgl usw "
    "т т.е е г им руб стр см рис ул д डॉ श्री د".split()
)
STEP_RE = re.compile(r"^\s*(?:(?:step|schritt|étape|paso)\s*\d*\s*[.:)]?|\d+\s*[.:)])\s*(?:\*\*[^*]*(?:\*\*)?)?\s*$", re.I)
LIST_RE = re.compile(r"^\s*[-*•]\s+\S")
PAIRS = [("“", "”"), ("«", "»"), ("「", "」"), ("『", "』"), ("(", ")"), ("[", "]")]
LAST_TOKEN = re.compile(r"(\S+)\s*$")
SEGMENT_SPLIT = re.compile(r"(?<=[.!?。！？।؟…])[\"'”’»“)\]]*\s+|\n+")
NAME_RE = re.compile(r"[A-ZÀ-Þ][^\W\d_]+(?:[ -][A-ZÀ-Þ][^\W\d_]+)*")
DIGITS = re.compile(r"\d+")
#: Patterns valid in Python and Java alike: markup and section markers, and words for a missing value.
MARKUP = r"\[\[ ?##.*?## ?\]\]|</?[A-Za-z][^<>]*>|```\w*"
MISSING = r"(?i)(none|null|nan|n ?a|na|nil|void|empty|blank|undefined|unknown|missing|no answer|not available|not applicable|tbd)"
SPACES = "\u200b\ufeff\u00ad"
ANSWER_RE = re.compile(
    r"(?:answer|result|ergebnis|antwort|résultat|réponse|resultado|respuesta|ответ|итак|答案|答え|उत्तर|الجواب|คำตอบ)\W*(?:is|lautet|est donc|est|es|это|是|は|هو|คือ)?\s*[*:：\s]*", re.I
)


def template(segment: str) -> str:
    """The segment with names after its first word and numbers masked."""
    s = DIGITS.sub("9", segment.strip())
    head, _, rest = s.partition(" ")
    return (head + " " + NAME_RE.sub("X", rest)).strip() if rest else head


def unclosed(line: str) -> bool:
    """Whether a quotation or bracket opened in the line stays open at its end."""
    for a, b in PAIRS:
        k = line.count(a)
        if k and k > line.count(b) and not (a == "“" and "„" in line):
            return True
    return line.count("„") > line.count("“") + line.count("”")


def last_segments(tail: str) -> tuple[str, str, str]:
    """(last line, the segment before the last, the last segment)."""
    line = tail.rsplit("\n", 1)[-1]
    parts = [x for x in SEGMENT_SPLIT.split(tail) if x and x.strip()]
    return line, parts[-2] if len(parts) > 1 else "", parts[-1] if parts else ""


def prefix_of(part: str, intact: str) -> bool:
    return bool(part) and len(part) < len(intact) and intact.startswith(part)


def broken_answer(tail: str, intact: str) -> bool:
    """Whether the tail ends with an answer line that holds only a beginning of the intact answer."""
    last = None
    for last in ANSWER_RE.finditer(tail):
        pass
    if last is None:
        return False
    said = tail[last.end() :].strip()
    if not said:
        return False
    said = said.rstrip(".…。� ")
    return prefix_of(said, intact.rstrip(". "))


#: What look() tells ends apart as.
STATES = ["done", "open", "broken", "mark", "item", "thai"]
TOKEN = re.compile(r"[^\W_]+|[^\w\s]")
ONE_NAME = re.compile(r"[A-ZÀ-Þ][^\W\d_]+")


def end_grams(tail: str, given: bool) -> list[int]:
    """Hashed n-grams that end where the text does: its last 1 to 4 words and marks, names and numbers masked; apart for
    texts that end with an answer."""
    w = ["9" if x.isdigit() else "xx" if ONE_NAME.fullmatch(x) else x.lower() for x in TOKEN.findall(tail[-200:])[-4:]]
    mark = "$$" if given else "$"
    return linear.hashed({mark + " ".join(w[-n:]) for n in range(1, len(w) + 1)})


def states_answer(tail: str) -> bool:
    """Whether the last line says what the answer is."""
    line = tail.rstrip().rsplit("\n", 1)[-1]
    last = None
    for last in ANSWER_RE.finditer(line):
        pass
    return last is not None and any(ch.isalnum() for ch in line[last.end() :])


def look(tail: str, intact: str | None) -> tuple[str, str, str]:
    """('done' | 'open' | 'mark' | 'broken', template of the last segment, template of the one before).

    done: a sentence, answer, row or list item ends here; open: no terminal mark; mark: ends in a run of dots that a
    sentence may also have; broken: what stands here can't be an end.
    """
    raw = tail
    t = tail.rstrip().rstrip(SPACES).rstrip()
    if not t:
        return "done", "", ""
    whole = (intact or "").strip()
    line, before, seg = last_segments(t)
    bt = template(before)
    if "�" in t[-3:]:
        return "broken", "", bt
    if whole and len(whole) > 0 and (t.endswith(whole) or t.rstrip(".。 ").endswith(whole.rstrip(". "))):
        return "done", "", bt
    if whole and broken_answer(t[-len(whole) - 80 :], whole):
        return "broken", "", bt
    m = MARK_RE.search(t)
    if m and m.end() == len(t) and m.group(0).strip():
        mark = m.group(0).strip()
        if mark in ("…", "...", "......"):
            words = seg.split()
            if not words:
                return "broken", "", bt
            return "mark", f"{words[0]} {words[-1]}", bt
        return "broken", "", bt
    if STEP_RE.match(line):
        return "broken", "", bt
    end = END_RE.search(t)
    if end:
        if unclosed(line):
            return "broken", "", bt
        if t[end.start()] == ".":
            word = LAST_TOKEN.search(t[: end.start()])
            w = word.group(1).lower().lstrip("([\"'“„«") if word else ""
            if w in ABBREVIATIONS or (len(w) == 1 and w.isalpha() and w.isascii() and word.group(1)[-1].isupper()):
                return "broken", "", bt
        return "done", template(seg), bt
    if t.endswith("|") or t.endswith("```"):
        return "done", "", bt
    if raw.endswith((" ", "\n")) and t[-1].isalnum() and not LIST_RE.match(line):
        return "open", template(seg), bt
    if LIST_RE.match(line) and len(line.split()) >= 2:
        return "item", "", bt
    if "฀" <= t[-1] <= "๿":
        return "thai", "", bt
    return "open", template(seg), bt
