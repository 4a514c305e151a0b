"""English stemming (the published Porter2 / Snowball algorithm) of words and short texts as Arrow UDFs.

Spark has no stemmer.  Tables of texts are stemmed by ``operators.stemming``, which calls the UDF for
distinct words only.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---- fixed values of the published algorithm ------------------------------------------------
SPECIAL_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
STOP_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
REGION_PREFIXES = ("gener", "commun", "arsen")
DERIVED_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able",
    "entli": "ent", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
ADJECTIVE_SUFFIXES = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
DROPPED_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)
# ---- end of fixed values --------------------------------------------------------------------

_AFTER_VOWEL_RUN = re.compile(r"[aeiouy][^aeiouy]")
_HAS_VOWEL = re.compile(r"[aeiouy]")
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
_DOUBLE_END = re.compile(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")


def _regions(word: str) -> tuple[int, int]:
    first = next((len(p) for p in REGION_PREFIXES if word.startswith(p)), None)
    if first is None:
        found = _AFTER_VOWEL_RUN.search(word)
        first = found.end() if found else len(word)
    found = _AFTER_VOWEL_RUN.search(word, first)
    return first, found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _HAS_VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _past_or_gerund(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not _HAS_VOWEL.search(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _DOUBLE_END.search(base):
        return base[:-1]
    return base + "e" if _SHORT_END.search(base) and len(base) <= r1 else base


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in SPECIAL_WORDS:
        return SPECIAL_WORDS[word]
    word = word.removeprefix("'")
    word = re.sub(r"^y|(?<=[aeiouy])y", "Y", word)
    r1, r2 = _regions(word)
    word = re.sub(r"('s'|'s|')$", "", word)
    word = _plural(word)
    if word in STOP_AFTER_PLURAL:
        return word
    word = _past_or_gerund(word, r1)
    word = re.sub(r"(?<=.[^aeiouy])[yY]$", "i", word)

    suffix = _longest(word, DERIVED_SUFFIXES)
    if suffix and len(word) - len(suffix) >= r1:
        before = word[: -len(suffix)][-1:]
        allowed = {"ogi": "l", "li": "cdeghkmnrt"}.get(suffix)
        if allowed is None or (before and before in allowed):
            word = word[: -len(suffix)] + DERIVED_SUFFIXES[suffix]

    suffix = _longest(word, ADJECTIVE_SUFFIXES)
    if suffix and len(word) - len(suffix) >= (r2 if suffix == "ative" else r1):
        word = word[: -len(suffix)] + ADJECTIVE_SUFFIXES[suffix]

    suffix = _longest(word, DROPPED_SUFFIXES)
    if suffix and len(word) - len(suffix) >= r2:
        if suffix != "ion" or word[:-3].endswith(("s", "t")):
            word = word[: -len(suffix)]

    base = word[:-1]
    if word.endswith("e"):
        if len(base) >= r2 or (len(base) >= r1 and not _SHORT_END.search(base)):
            word = base
    elif word.endswith("ll") and len(base) >= r2:
        word = base
    return word.replace("Y", "y")


@F.pandas_udf(StringType())
def stem_words(words: pd.Series) -> pd.Series:
    """Stem of each word."""
    return words.map(stem_word, na_action="ignore")


@F.pandas_udf(StringType())
def stem_text(texts: pd.Series) -> pd.Series:
    """Stem every space-separated word of each text."""
    return texts.map(
        lambda t: " ".join(stem_word(w) for w in t.split()), na_action="ignore"
    )
