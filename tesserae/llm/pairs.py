"""Broken prompt and response pairs: a multi-label linear classifier over hashed n-grams and pair features.

Training makes its own labels: from a bounded sample of natural rows (TRAIN_ROWS) responses are truncated, copied from
their question, swapped for responses in other languages, refused and emptied; natural responses are the negatives. One
logistic model per defect is fitted twice: natural responses that first fits on other rows are sure of aren't negatives
of the second. Thresholds are calibrated on held-out rows, and every field of every row is scored in Arrow batches. The
model decides; no rule follows it.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm import lang, linear, tails
from tesserae.session import if_small, spread, thinned

TRAIN_ROWS = 2000  # natural rows, at most, that the classifier is fitted on
TRAIN_CHARS = 20_000  # longer responses are judged, but not fitted on, so that the sample has a bound in bytes, too
LEAST_ROWS = 1000  # rows that synthetic defects are made of, at least; fewer are used more than once
SURE = 0.0  # log-odds of a defect above which a first fit on other rows takes a natural response for no negative
DEFECTS = ["empty", "copies_question", "refusal", "other_language", "truncated"]
FIELDS = ["final_answer_sql", "llm_generated_reasoning_traces"]
SCHEMA = "seq bigint, field string, defect string"

WORD = re.compile(r"[^\W_]+")
MARKUP = re.compile(tails.MARKUP)
MISSING = re.compile(tails.MISSING.replace("(?i)", "^") + "$", re.I)
PUNCT = re.compile(r"[\W_]+")
NAME = re.compile(r"[A-ZÀ-Þ][^\W\d_]+")
LABELS = set("q a question prompt query task frage aufgabe pregunta consulta the is asked original here again user".split()) | {"вопрос", "问题", "質問"}
SENT = re.compile(r"(?<=[.!?。！？।])\s+|\n+")
#: Ways to decline, by language, that refused responses are made of: openings, cores, endings.
DECLINE = {
    "en": (
        ["", "I'm sorry, but ", "Unfortunately, ", "Regrettably, ", "As an assistant, ", "After reading everything, ", "I apologize; ", "Sorry, "],
        ["I can't provide an answer to this", "I must decline to answer", "I won't be able to complete this task", "no conclusion can be offered here", "the documents give me no basis for any answer", "answering this is outside what I can do", "it is not possible for me to answer from these documents", "I am not able to help with that request", "I cannot answer this question", "I am unable to answer", "I have to give up here", "I don't know the answer", "there is not enough information to answer"],
        [".", " at this time.", " and I would rather not guess.", ", so I will stop here.", ". Please supply more material.", ". Let me know if you have another question."],
    ),
    "de": (["", "Leider ", "Es tut mir leid, "], ["Ich kann dabei nicht helfen", "Dazu liegen mir keine Angaben vor, ich muss passen", "kann ich diese Frage nicht beantworten", "Ich kann diese Frage nicht beantworten", "eine Antwort ist mir nicht möglich", "Ich muss die Antwort schuldig bleiben"], ["."]),
    "fr": (["", "Désolé, ", "Malheureusement, "], ["je préfère ne pas répondre", "Il m'est impossible de conclure", "Je ne peux pas répondre à cette question", "je ne suis pas en mesure de répondre", "je dois renoncer à répondre"], ["."]),
    "es": (["", "Lo siento, ", "Por desgracia, "], ["No puedo responder a esta pregunta", "debo abstenerme de responder", "Me es imposible dar una respuesta", "no me es posible contestar", "prefiero no responder"], ["."]),
}
#: Seeds in scripts that no natural question of the sample may have.
FOREIGN = [
    "Башня построена в 1801 г. и стоит до сих пор. Ответ: {}.", "Кто оплатил работы? Итак, это {}.", "这座灯塔真高！谁支付了费用？\n答案是{}。", "记录显示大桥建于1917年。答案是{}。", "これは見事な灯台だ！\n答えは{}です。", "記録によると、費用は円だった。答えは{}です。",
    "بني الجسر عام 1841. الجواب هو {}.", "यह पुल बहुत पुराना है! उत्तर {} है।", "ใครเป็นผู้จ่ายค่าสะพาน คำตอบคือ{}", "Die alte Brücke wurde am 1. Mai eröffnet. Also lautet das Ergebnis {}.", "Wer hat die Mühle bezahlt? Antwort: {}", "La pequeña torre se terminó en 1874. Por tanto, el resultado es {}.",
    "¿Quién pagó la mina? Respuesta: {}", "Qui a payé la halle ? Le résultat est donc {}.", "La petite écluse fut achevée en 1806. Réponse : {}", "The canal was moved, which fits the clue. So the result is {}.", "The filter leaves two candidates. Final answer: {}",
]


def bare(text: str) -> str:
    return PUNCT.sub(" ", MARKUP.sub(" ", text)).strip()


def is_void(text: str | None) -> bool:
    """Nothing but blanks, punctuation, markup, section markers or a word for a missing value."""
    if text is None:
        return True
    b = bare(text)
    return not b or bool(MISSING.match(b))


LABEL = re.compile(r"^[\w ]{1,25}: ")
ENDS = re.compile(r"[\s…�.?!\"”“]+$")


def begins_and_breaks_off(text: str, question: str) -> bool:
    """Whether a text, its label aside, begins as the question does but does not end with the whole of it: a restated
    question that was cut, while a copy in another order begins elsewhere."""
    a, b = ENDS.sub("", LABEL.sub("", text.strip())).lower(), ENDS.sub("", question.strip()).lower()
    return len(b) > 25 and a.startswith(b[:25]) and not a.endswith(b)


class Pair:
    """What one response and its question share; the values that the features are made of."""

    __slots__ = ("answer", "answered", "bags", "cover", "cut_copy", "ended", "foreign", "inside", "lead", "length", "qlang", "ratio", "rlang", "same_end", "state", "tail", "text", "void", "weight", "words")

    def __init__(self, question: str | None, text: str | None, intact: str | None, is_answer: bool, qcache: dict) -> None:
        self.text, self.answer, self.bags = text, is_answer, None
        self.void = is_void(text)
        if self.void:
            return
        q = question or ""
        hit = qcache.get(q)
        if hit is None:
            if len(qcache) > 4096:
                qcache.clear()
            hit = qcache[q] = (set(WORD.findall(q.lower())), lang.best(lang.votes(q))[0], len(q))
        qset, self.qlang, qlen = hit
        whole = (intact or "").strip()
        stripped = text.strip()
        self.same_end = bool(whole) and (stripped == whole or (not is_answer and (stripped.endswith(whole) or stripped.rstrip(".。 ").endswith(whole.rstrip(". ")))))
        self.words = WORD.findall(text.lower())
        if self.words:
            mine = [w for w in self.words if w not in LABELS] or list(self.words)
            inside = sum(w in qset for w in mine)
            self.inside = inside / len(mine)
            self.cover = len(qset & set(mine)) / max(1, len(qset))
        else:
            self.inside = self.cover = 0.0
        self.cut_copy = self.inside > 0.8 and begins_and_breaks_off(text, q)
        self.length = len(text)
        self.ratio = len(text) / max(1, qlen)
        self.tail = text[-tails.TAIL_CHARS :]
        if is_answer:
            cut = stripped.rstrip(".…�- \t").strip()
            cut = re.sub(r"\s*[\[<(](?:truncated|cut|\.\.\.|…)[\])>]$", "", cut).rstrip(".… ")
            if self.same_end:
                self.state = "done"
            elif whole and len(cut) < len(whole.rstrip(". ")) and whole.startswith(cut):
                self.state = "broken"
            else:
                self.state = tails.look(self.tail, None)[0]
                if self.state in ("open", "item", "thai"):
                    self.state = "loose"
        else:
            self.state = tails.look(self.tail, intact)[0]
        body = text
        if whole and self.same_end:
            body = stripped[: max(0, len(stripped.rstrip(".。 ")) - len(whole.rstrip(". ")))]
        if len(q) > 25:
            body = body.replace(q.strip(), " ")  # a restated question says nothing about the response's own language
        self.answered = tails.states_answer(self.tail)
        scores = lang.votes(body) if not (is_answer and self.same_end) else {}
        self.rlang, self.weight, self.lead = lang.best(scores)
        own = scores.get(self.qlang, 0.0)
        self.foreign = (self.weight - own) / (self.weight + own + 0.5) if self.qlang and self.rlang and self.rlang != self.qlang else 0.0

    def dense(self) -> list[float]:
        if self.void:
            return [1.0] + [0.0] * (N_DENSE - 2) + [1.0 if self.answer else 0.0]
        copied = max(0.0, self.inside - 0.8) * 5 * min(1.0, self.cover / 0.7)
        whole = self.inside >= 0.9 and self.cover >= 0.6 and self.ratio > 0.55
        given = self.given()
        state = STATES.index(self.state)
        return [
            0.0, self.inside, self.cover, copied, float(whole and not self.same_end), float(whole and self.cut_copy and self.state != "done"), min(2.0, self.ratio),
            *(float(i == state) for i in range(len(STATES))), float(self.state in STATES[1:4] and not self.same_end), float(self.state in STATES[1:4] and not given and not whole), float(whole and self.state in STATES[1:4] and not self.cut_copy),
            float(self.same_end), float(given), self.foreign, float(self.foreign > 0.5 and self.weight >= 1.5), min(1.0, self.lead / 5), float(self.answer),
        ]

    def given(self) -> bool:
        return self.same_end or (self.answered and not self.answer)

    def grams(self) -> list[list[int]]:
        """Hashed 1- to 3-grams, names and numbers masked, of each sentence of the whole response."""
        if self.void:
            return []
        if self.bags is not None:
            return self.bags
        self.bags = bags = []
        for s in SENT.split(self.text.strip()):
            head, _, rest = s.strip().partition(" ")
            w = ["9" if x.isdigit() else x for x in WORD.findall((head + " " + NAME.sub("xx", rest)).lower())]
            if w:
                bags.append(linear.hashed({" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}))
        return bags

    def end_grams(self) -> list[int]:
        """Hashed n-grams that end where the response does, apart for responses that end with an answer."""
        return [] if self.void else tails.end_grams(self.tail, self.given())


STATES = [*tails.STATES, "loose"]
N_DENSE = 16 + len(STATES)
REFUSAL, TRUNCATED = DEFECTS.index("refusal"), DEFECTS.index("truncated")


class Model:
    """One row per defect over N_DENSE pair features and a bias, and one weight per hashed n-gram: those of the sentence
    that looks most like a refusal speak for 'refusal', those of the end for 'truncated'."""

    def __init__(self) -> None:
        self.dense = np.zeros((len(DEFECTS), N_DENSE + 1), np.float64)
        self.hashed = np.zeros((2, 1 << linear.BITS), np.float64)
        self.threshold = np.zeros(len(DEFECTS))

    def scores(self, p: Pair) -> np.ndarray:
        z = self.dense[:, :N_DENSE] @ np.asarray(p.dense()) + self.dense[:, N_DENSE]
        bags, end = p.grams(), p.end_grams()
        if bags:
            said = self.hashed[0]
            z[REFUSAL] += max(said[g].sum() / len(g) ** 0.5 for g in bags)
        if end:
            z[TRUNCATED] += self.hashed[1][end].sum() / len(end) ** 0.5
        return z

    def defect(self, p: Pair) -> str | None:
        """The defect whose score lies furthest above its threshold."""
        z = self.scores(p) - self.threshold
        k = int(z.argmax())
        return DEFECTS[k] if z[k] >= 0 else None

    def fit(self, pairs: list[Pair], labels: np.ndarray, epochs: int = 24, rate: float = 0.4, batch: int = 64, seed: int = 7) -> Model:
        """Adagrad on the logistic loss in small batches over all labels. Of a row's sentences the one that looks most
        like a refusal at the start of an epoch counts."""
        rng = np.random.default_rng(seed)
        n = len(pairs)
        x = np.ones((n, N_DENSE + 1))
        x[:, :N_DENSE] = [p.dense() for p in pairs]
        bags = [(i, np.asarray(g, np.int64)) for i, p in enumerate(pairs) for g in p.grams()]
        ends = [np.asarray(p.end_grams(), np.int64) for p in pairs]
        owner = np.asarray([i for i, _ in bags], np.int64)
        sizes = np.asarray([len(g) for _, g in bags], np.int64)
        flat = np.concatenate([g for _, g in bags]) if bags else np.empty(0, np.int64)
        stops = np.cumsum(sizes)
        none = np.empty(0, np.int64)
        hd, hh = np.full_like(self.dense, 1e-3), np.full_like(self.hashed, 1e-3)
        for _ in range(epochs):
            said = [none] * n
            if len(bags):
                looks = np.add.reduceat(self.hashed[0][flat], stops - sizes) / np.sqrt(sizes)
                for j in np.lexsort((looks, owner)):  # the last of each owner has its greatest
                    said[owner[j]] = bags[j][1]
            for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
                z = x[rows] @ self.dense.T
                held = []
                for h, k, of in ((0, REFUSAL, said), (1, TRUNCATED, ends)):
                    lens = np.asarray([len(of[r]) for r in rows], np.int64)
                    idx = np.concatenate([of[r] for r in rows])
                    row = np.repeat(np.arange(len(rows)), lens)
                    scale = 1.0 / np.sqrt(np.repeat(lens, lens))
                    z[:, k] += np.bincount(row, self.hashed[h][idx] * scale, len(rows))
                    held.append((h, k, idx, row, scale))
                err = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[rows]
                grad = err.T @ x[rows]
                hd += grad * grad
                self.dense -= 2 * rate * grad / np.sqrt(hd)
                for h, k, idx, row, scale in held:
                    touched, inv = np.unique(idx, return_inverse=True)
                    g = np.bincount(inv, err[row, k] * scale, len(touched))
                    hh[h][touched] += g * g
                    self.hashed[h][touched] -= rate * g / np.sqrt(hh[h][touched])
        return self

    def calibrate(self, pairs: list[Pair], labels: np.ndarray) -> Model:
        """Per defect the threshold with the least share of errors among held-out positives plus that among negatives, in
        the middle of the widest such gap."""
        z = np.asarray([self.scores(p) for p in pairs])
        for k in range(len(DEFECTS)):
            pos, neg = z[labels[:, k] == 1, k], z[labels[:, k] == 0, k]
            if not len(pos):
                self.threshold[k] = 1e9
                continue
            self.threshold[k] = linear.threshold(pos, neg)
        return self


def synthesize(rows: list[dict], seed: int = 11) -> tuple[list[tuple[str | None, str | None, str | None, bool]], list[int]]:
    """(question, response, intact answer, is an answer) and the index of the label, -1 for none."""
    rng, place = random.Random(seed), random.Random(seed + 1)
    out: list[tuple[str | None, str | None, str | None, bool]] = []
    labels: list[int] = []
    by_lang: dict[str, list[dict]] = {}
    for r in rows:
        r["ql"] = lang.best(lang.votes(r["question"] or ""))[0]
        by_lang.setdefault(r["ql"], []).append(r)
    langs = sorted(by_lang)
    for r in rows:
        q, whole = r["question"], r["intact"]
        for field in FIELDS:
            text, ans = r[field], field == FIELDS[0]
            if text is None:
                continue
            out.append((q, text, whole, ans)), labels.append(-1)
        trace = r[FIELDS[1]] or ""
        kind = rng.random()
        if kind < 0.3 and len(trace) > 60:
            allowed = [i for i in range(20, len(trace) - 4) if trace[i - 1].isalnum()]  # places after a letter or digit of any script
            if allowed:
                cut = trace[: rng.choice(allowed)]
                out.append((q, cut + rng.choice(["", "", "", "…", "...", " [truncated]", "�", " "]), whole, False)), labels.append(4)
        elif kind < 0.4 and whole and len(whole) > 6:
            out.append((q, whole[: rng.randint(2, len(whole) - 3)] + rng.choice(["", "", "…", "..."]), whole, True)), labels.append(4)
        lines = [x for x in trace.split("\n") if x.strip()]
        if len(lines) > 1 and rng.random() < 0.6:  # a finished response that states no answer is no defect
            said = "\n".join(lines[: rng.randint(1, len(lines) - 1)])
            out.append((q, said, whole, False)), labels.append(-1)
        if q and len(q) > 40 and rng.random() < 0.4:
            w = q.split(" ")
            k = rng.randint(1, len(w) - 1)
            form = rng.choice([q, q.upper(), q.lower(), f"Q: {q}", f"Question: {q}", f"{q}\n{q}", " ".join(w[k:] + w[:k]), " ".join(x for x in w if rng.random() > 0.07)])
            out.append((q, form, whole, rng.random() < 0.5)), labels.append(1)
        if rng.random() < 0.5:
            a, b, c = DECLINE[r["ql"] if r["ql"] in DECLINE else "en"]
            said = rng.choice(a) + rng.choice(b) + rng.choice(c)
            said = said[0].upper() + said[1:]
            lines = [x for x in SENT.split(trace) if x.strip()]
            if rng.random() < 0.4 and len(lines) > 2:
                said = rng.choice([" ", "\n\n"]).join([*lines[: rng.randint(1, len(lines) - 1)], said])
            elif len(lines) > 2 and place.random() < 0.5:  # declined at the start, then explained
                said = place.choice([" ", "\n\n"]).join([said, *lines[: place.randint(1, len(lines) - 1)]])
            out.append((q, said, whole, rng.random() < 0.4)), labels.append(2)
            if whole and len(lines) > 1 and place.random() < 0.5:  # a doubt that is resolved later is none
                out.append((q, place.choice([" ", "\n\n"]).join([place.choice(a) + place.choice(b) + place.choice(c), *lines[:-1], f"Final answer: {whole}"]), whole, False)), labels.append(-1)
        if rng.random() < 0.4:
            other = [x for x in langs if x and x != r["ql"] and by_lang[x]]
            foreign = rng.choice(FOREIGN).format(whole or "x")
            if other and rng.random() < 0.5:
                foreign = rng.choice(by_lang[rng.choice(other)])[FIELDS[1]] or foreign
            own = [x for x in trace.split("\n") if x.strip()]
            if own and place.random() < 0.3:  # most of it in another language, between an opening and an end that aren't
                foreign = "\n".join([own[0], *[foreign] * place.randint(3, 30), own[-1]])
            if lang.best(lang.votes(foreign))[0] not in ("", r["ql"]):  # else it happens to be in the question's language
                out.append((q, foreign, whole, rng.random() < 0.4)), labels.append(3)
        if rng.random() < 0.12:
            out.append((q, rng.choice(["", " ", "\n\n", "-", "...", "none", "N/A", "NaN", "null", "{}", "[]", "''", "```\n```", "<answer></answer>", "[[ ## answer ## ]]\n\n[[ ## completed ## ]]", None]), whole, rng.random() < 0.5)), labels.append(0)
    return out, labels


def labelled(sample: list[dict], seed: int = 11, least: int = LEAST_ROWS) -> tuple[list[Pair], np.ndarray]:
    """Responses with labels; a sample of fewer than least rows is drawn from repeatedly."""
    pairs: list[Pair] = []
    labels: list[list[int]] = []
    qcache: dict = {}
    for k in range(-(-least // max(1, len(sample))) if len(sample) >= 5 else 1):
        raw, kinds = synthesize(sample, seed + 100 * k)
        pairs += [Pair(q, text, whole, ans, qcache) for q, text, whole, ans in raw]
        labels += [[int(d == kind) for d in range(len(DEFECTS))] for kind in kinds]
    return pairs, np.asarray(labels, np.float64).reshape(len(labels), len(DEFECTS))


def train(sample: list[dict]) -> Model:
    """Fit and calibrate on the sample. Of fewer than 10 responses nothing is learned, and nothing is flagged but what
    is empty."""
    pairs, y = labelled(sample)
    if len(pairs) < 10:
        model = Model()
        model.threshold[:] = 1e9
        model.dense[0, 0], model.threshold[0] = 1.0, 0.5
        return model
    test = np.arange(len(pairs)) % 5 == 0
    part = lambda m: [p for p, keep in zip(pairs, m, strict=True) if keep]
    # natural defects among the negatives: each half is judged by a fit on the other, and what that is sure of isn't used
    half = np.arange(len(pairs)) // 5 % 2 == 0
    sure = np.zeros(len(pairs), bool)
    for side in (half, ~half):
        other = Model().fit(part(side), y[side], epochs=8)
        sure |= np.asarray([not side[i] and y[i].sum() == 0 and other.scores(p).max() > SURE for i, p in enumerate(pairs)], bool)
    keep = ~sure
    return Model().fit(part(~test & keep), y[~test & keep]).calibrate(part(test & keep), y[test & keep])


def with_intact(attempts: DataFrame, intact: DataFrame | None, key: str = "sample_id") -> DataFrame:
    """The rows with the intact answer of their sample, where there is one; a sample that is listed twice gives one. The
    answers go to every task if they are few, so that no long text is shuffled for them; else both sides are."""
    if intact is None:
        return attempts.withColumn("intact", F.lit(None).cast("string"))
    one = intact.groupBy(F.col(key).alias("_k")).agg(F.max("final_answer_sql").alias("intact"))
    return attempts.join(if_small(one), F.col(key) == F.col("_k"), "left").drop("_k")


def fit_pairs(rows: DataFrame, intact: DataFrame | None, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the train_rows rows with the least hash of their key: a bounded sample that doesn't depend on file order."""
    cols = ["seq", "sample_id", "question", *FIELDS]
    sample = thinned(rows, "seq", train_rows).select(*cols).where(F.col("seq").isNotNull() & (F.coalesce(F.char_length(FIELDS[1]), F.lit(0)) + F.coalesce(F.char_length(FIELDS[0]), F.lit(0)) <= TRAIN_CHARS)).orderBy(F.xxhash64("seq"), "seq").limit(train_rows)
    return train([r.asDict() for r in with_intact(sample, intact).orderBy("seq").collect()])


def broken_pairs(rows: DataFrame, intact: DataFrame | None = None, model: Model | None = None) -> DataFrame:
    """One row (seq, field, defect) per defective field of every row.

    Nulls, empty and blank responses are 'empty'. A null question rules out copies_question and other_language. Rows
    that are repeated are judged each. An empty table gives no rows; of a table too small to learn from only 'empty' is
    told. Extra columns aren't read.
    """
    model = model or fit_pairs(rows, intact)
    slim = with_intact(spread(rows.select("seq", "sample_id", "question", *FIELDS)), intact).select("seq", "question", "intact", *FIELDS)
    carried = rows.sparkSession.sparkContext.broadcast((model.dense, model.hashed, model.threshold))  # of fixed size

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model()
        m.dense, m.hashed, m.threshold = carried.value
        qcache: dict = {}
        for b in batches:
            found = []
            for f, is_answer in ((FIELDS[0], True), (FIELDS[1], False)):
                for seq, q, whole, text in zip(b["seq"].tolist(), b["question"].tolist(), b["intact"].tolist(), b[f].tolist(), strict=True):
                    p = Pair(q, text, whole, is_answer, qcache)
                    d = m.defect(p)
                    if d:
                        found.append((seq, f, d))
            yield pd.DataFrame(found, columns=["seq", "field", "defect"])

    return slim.mapInPandas(judge, SCHEMA)
