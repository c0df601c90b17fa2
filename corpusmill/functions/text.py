"""Text functions on columns. NULL in gives NULL out everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.isspace() accepts. Spelled out, because \s means
# different sets in different regex engines.
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_RUN = f"[{SPACES}]+"
WORD_RUN = f"[^{SPACES}]+"
NON_SPACE = f"[^{SPACES}]"

# Everything that is not a letter, a number or an underscore.
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"
LETTERS_ONLY = r"^\p{L}+$"

# Contractions that the Treebank word tokenizer splits in two.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}

# First letter of a Penn Treebank tag to the lexical class of the dictionary.
TAG_CLASSES = {"J": "a", "V": "v", "N": "n", "R": "r"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_list(words: Sequence[str]) -> Column:
    """Constant ARRAY<STRING>, built as one folded literal however many words there are."""
    if not words:
        return F.array().cast("array<string>")
    return F.split(F.lit("\x1f".join(words)), "\x1f")


def is_nonblank(c: Column | str) -> Column:
    """True when at least one character is not whitespace."""
    return _col(c).rlike(NON_SPACE)


def strip(c: Column | str) -> Column:
    """Remove whitespace at both ends, over the whole Unicode set."""
    return F.regexp_replace(_col(c), f"^{SPACE_RUN}|{SPACE_RUN}$", "")


def collapse_whitespace(c: Column | str) -> Column:
    """Every whitespace run becomes one space; the ends are not trimmed."""
    return F.regexp_replace(_col(c), SPACE_RUN, " ")


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    return F.regexp_count(_col(c), F.lit(WORD_RUN))


def normalize_text(c: Column | str) -> Column:
    """Lower-case, then every run of non-word characters becomes one space."""
    return F.regexp_replace(F.lower(_col(c)), NON_WORD_RUN, " ")


def split_words(c: Column | str) -> Column:
    """Whitespace split without empty pieces."""
    return F.filter(F.split(_col(c), SPACE_RUN), lambda t: t != "")


def tokenize(c: Column | str, contractions: bool = True) -> Column:
    """Words of the normalised text; the six known contractions are split in two."""
    words = F.filter(normal_words(c), lambda t: t != "")
    if not contractions:
        return words

    def pieces(t: Column) -> Column:
        out = F.when(F.lit(False), F.array(t))
        for word, parts in CONTRACTIONS.items():
            out = out.when(t == word, string_list(parts))
        return out.otherwise(F.array(t))

    # Few texts hold a contraction, so the per-word CASE runs only for those.
    has_any = F.arrays_overlap(words, string_list(list(CONTRACTIONS)))
    return F.when(has_any, F.flatten(F.transform(words, pieces))).otherwise(words)


def remove_stopwords(tokens: Column | str, stopwords: Sequence[str]) -> Column:
    """Drop listed words, keeping order and repeats."""
    return F.filter(_col(tokens), lambda t: ~t.isin(list(stopwords))) if stopwords else _col(tokens)


def normal_words(c: Column | str) -> Column:
    """Words of the normalised text. A normalised text has no other whitespace than the space, so
    it is split at that; empty pieces can be left at the ends."""
    return F.split(normalize_text(c), " ")


def item_set(words: Column | str, stopwords: Sequence[str], min_length: int = 3) -> Column:
    """Sorted distinct words that are purely alphabetic, long enough and not stop words."""
    kept = F.filter(F.array_distinct(_col(words)), lambda t: (F.char_length(t) >= min_length) & t.rlike(LETTERS_ONLY))
    if stopwords:
        kept = F.array_except(kept, string_list(stopwords))
    return F.array_sort(kept)


def itemset_to_string(items: Column | str) -> Column:
    """``a - b - c`` in sorted order."""
    return F.array_join(F.array_sort(_col(items)), " - ")


def lexical_class(tag: Column | str) -> Column:
    """Part-of-speech tag to dictionary class; anything unknown counts as a noun."""
    initial = F.substring(_col(tag), 1, 1)
    out = F.when(F.lit(False), F.lit("n"))
    for letter, cls in TAG_CLASSES.items():
        out = out.when(initial == letter, F.lit(cls))
    return out.otherwise(F.lit("n"))


def term_tokens(c: Column | str, stopwords: Sequence[str]) -> Column:
    """Lower-cased words of at least two word characters, stop words removed."""
    return remove_stopwords(F.filter(normal_words(c), lambda t: F.char_length(t) >= 2), stopwords)


def ngrams(tokens: Column | str, n: int) -> Column:
    """All n-grams of a token array, words joined by one space."""
    tok = _col(tokens)
    grams = tok
    for k in range(2, n + 1):
        count = F.greatest(F.size(tok) - F.lit(k - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), count), F.slice(tok, F.lit(k), count), lambda a, b: F.concat_ws(" ", a, b)
        )
    return grams


def ngrams_up_to(tokens: Column | str, max_n: int = 3) -> Column:
    """1-grams, then 2-grams, and so on up to ``max_n``."""
    return F.concat(*[ngrams(tokens, n) for n in range(1, max_n + 1)])
