"""Text cleaning as column expressions, and tokens."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from blotterlake.functions.stem import stem_text

# ---- fixed values -------------------------------------------------------------------------
# The common English stop-word list (public domain, as distributed with most text toolkits).
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them "
    "their theirs themselves what which who whom this that that'll these those am is are was "
    "were be been being have has had having do does did doing a an the and but if or because "
    "as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there "
    "when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y "
    "ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
# Letters that become two letters when written without marks.
LETTER_PAIRS = {"æ": "ae", "œ": "oe", "ß": "ss", "þ": "th", "Æ": "AE", "Œ": "OE", "Þ": "Th"}
# ---- end of fixed values ------------------------------------------------------------------


def _unmarked_letters() -> tuple[str, str]:
    """Every accented Latin letter and its base letter, from the Unicode decompositions."""
    marked, plain = "øØłŁđĐðÐıħĦŧŦ", "oOlLdDdDihHtT"
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha() and chr(code) not in marked:
            marked, plain = marked + chr(code), plain + base
    return marked, plain


MARKED_LETTERS, PLAIN_LETTERS = _unmarked_letters()
# A word with its inner hyphens, a run of space, or one other sign.
WORD = r"[\p{L}\p{N}_]"
WORD_OR_GAP = rf"{WORD}+(?:-{WORD}+)*|\s+|[^\p{{L}}\p{{N}}_\s]"
TOKEN = WORD + "{2,}"


def remove_diacritics(text: Column) -> Column:
    """Latin letters without their marks, composed or combining.  Texts of ASCII only are passed over."""
    plain = F.regexp_replace(text, r"\p{M}+", "")
    for letter, pair in LETTER_PAIRS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(pair))
    plain = F.translate(plain, MARKED_LETTERS, PLAIN_LETTERS)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain)


def remove_digit_blocks(text: Column) -> Column:
    """Blank out whole numbers; digits inside a word stay."""
    return F.regexp_replace(text, r"(?U)\b\d+\b", " ")


def remove_stop_words(text: Column, words: tuple[str, ...] | list[str] = STOP_WORDS) -> Column:
    """Drop whole words of the list.  A hyphenated word counts as one word."""
    parts = F.regexp_extract_all(text, F.lit(WORD_OR_GAP), F.lit(0))
    return F.array_join(F.filter(parts, lambda part: ~part.isin(list(words))), "")


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Punct}+", " ")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s\x{A0}]+", " "))


def clean_text(text: Column, *, stem: bool = True) -> Column:
    """Lower-case, then remove marks, numbers, stop words, punctuation and extra space; stem."""
    text = remove_digit_blocks(remove_diacritics(F.lower(text)))
    text = collapse_whitespace(remove_punctuation(remove_stop_words(text)))
    return stem_text(text) if stem else text


def tokens(text: Column) -> Column:
    """Lower-case words of two or more characters, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so ``o'neil`` gives ``O'Neil``."""
    runs = F.regexp_extract_all(text, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def title_case_name(text: Column) -> Column:
    """Title-case a name and strip its full stops, apostrophes, commas and extra space."""
    bare = F.regexp_replace(F.trim(title_case(text)), r"[.',]", "")
    return title_case(F.regexp_replace(bare, r"\s+", " "))
