"""Script and language votes for short texts, from Unicode ranges and function words."""

from __future__ import annotations

import re

# Code-point ranges of the scripts told apart.
SCRIPTS = [
    ("kana", r"[぀-ヿ]"),
    ("han", r"[㐀-䶿一-鿿]"),
    ("cyrillic", r"[Ѐ-ӿ]"),
    ("arabic", r"[؀-ۿݐ-ݿ]"),
    ("devanagari", r"[ऀ-ॿ]"),
    ("thai", r"[฀-๿]"),
    ("hangul", r"[가-힯]"),
    ("greek", r"[Ͱ-Ͽ]"),
    ("hebrew", r"[֐-׿]"),
]
SCRIPT_RES = [(name, re.compile(pattern)) for name, pattern in SCRIPTS]
NON_LATIN = re.compile("[Ͱ-߿ऀ-ॿ฀-๿぀-ヿ㐀-䶿一-鿿가-힯]")

# Function words that are frequent in one language and rare in the others.
FUNCTION_WORDS = {
    "en": "the of and to was were is are that which by with from at for it not no but this who what has had been be so as if its near within among can will would let does did answer result".split(),
    "de": "der die das und ist nicht von mit zu wurde werden für auf den dem des ein eine im bei nach aus sich ich was wer dass noch also lautet kann leider keine mir nur hat welche einmal etwa stehen seit antwort ergebnis".split(),
    "fr": "le la les et est de du des un une pour dans par que qui sur pas fut près je il elle ce cette au aux donc quel quelle ne a sa son d l n s en cite ses réponse résultat".split(),
    "es": "el la los las y es de del un una para en por que qué con se no fue su al lo quién según cerca hubo obra dar junto más tan puedo esta nadie tanto resultado respuesta".split(),
    "it": "il lo gli e è di del della un una per in che con si non fu al nel sono questo".split(),
    "pt": "o os as e é de do da um uma para em por que com se não foi ao no na são".split(),
    "nl": "de het een en is van met voor op niet dat die te zijn naar bij werd".split(),
}
WORD = re.compile(r"[^\W\d_]+")
VOTES: dict[str, list[str]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words:
        VOTES.setdefault(_w, []).append(_lang)


def votes(text: str) -> dict[str, float]:
    """Weight per language or script; a word shared by k languages gives each 1/k."""
    out: dict[str, float] = {}
    if NON_LATIN.search(text):
        n = 0
        for name, rx in SCRIPT_RES:
            k = len(rx.findall(text))
            if k:
                out[name] = k / 2.0
                n += k
        if out.get("kana", 0) >= 0.15 * out.get("han", 0) and "kana" in out:
            out["kana"] += out.pop("han", 0)
    for w in WORD.findall(text.lower()):
        langs = VOTES.get(w)
        if langs:
            share = 1.0 / len(langs)
            for one in langs:
                out[one] = out.get(one, 0.0) + share
    return out


def best(scores: dict[str, float]) -> tuple[str, float, float]:
    """(language, its weight, its lead over the next); ties go to the first name in order."""
    if not scores:
        return "", 0.0, 0.0
    ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
    return ranked[0][0], ranked[0][1], ranked[0][1] - (ranked[1][1] if len(ranked) > 1 else 0.0)
