"""Text measures used by segmentation and quality scoring."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import let, strip

# A token is a run of letters, digits and marks, or one other visible character.
# Classes are spelled out so that the JVM, Python and SQL engines agree on every character.
TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_\p{Z}\p{Cc}]"

# Limits of the text filter.
MIN_CHARS = 20
MIN_ALNUM_RATIO = 0.2
MIN_DISTINCT_CHARS = 5
MAX_ODD_RATIO = 0.2
ODD_CHARS = r"[\x{1D400}-\x{1D7FF}\x{1F000}-\x{1FAFF}\x{FFFD}]"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(text: str | Column) -> Column:
    """I11. Number of tokens of a text."""
    return F.size(F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), F.lit(0)))


def is_clean(text: str | Column, min_chars: int = MIN_CHARS) -> Column:
    """I14. Keep readable text: long enough, enough letters, some variety, few odd characters."""
    c = _c(text)
    n = F.char_length(c)
    long_enough = (F.char_length(strip(c)) >= min_chars) if min_chars else F.lit(True)
    # runs, not single characters, are replaced: far fewer matches
    alnum = n - F.char_length(F.regexp_replace(c, r"[\p{L}\p{N}]+", ""))
    odd = n - F.char_length(F.regexp_replace(c, f"{ODD_CHARS}+", ""))
    return F.coalesce(
        (n > 0) & long_enough & (alnum >= n * F.lit(MIN_ALNUM_RATIO))
        & _has_variety(c) & (odd <= n * F.lit(MAX_ODD_RATIO)), F.lit(False))


def _has_variety(text: Column) -> Column:
    """At least MIN_DISTINCT_CHARS different characters: something is left after taking out the first ones.

    Most texts show them at once, so the start is looked at before the whole text is.
    """
    def rest(c: Column, n: int) -> Column:
        return c != "" if n == 0 else let(F.replace(c, F.substring(c, 1, 1), F.lit("")), lambda r: rest(r, n - 1))

    return rest(F.substring(text, 1, 64), MIN_DISTINCT_CHARS - 1) | rest(text, MIN_DISTINCT_CHARS - 1)


def bleu(candidate: list[str], reference: list[str], max_n: int = 4, k: int = 5) -> float:
    """BLEU-4 of one pair, smoothed for zero matches by length (method 4 of Chen and Cherry 2014)."""
    if not candidate or not reference:
        return 0.0
    logs, zeros = 0.0, 0
    for n in range(1, max_n + 1):
        grams = Counter(zip(*(candidate[i:] for i in range(n))))
        known = Counter(zip(*(reference[i:] for i in range(n))))
        hits = sum((grams & known).values())
        total = max(1, sum(grams.values()))
        if n == 1 and hits == 0:
            return 0.0
        if hits == 0 and len(candidate) > 1:
            zeros += 1
            precision = math.log(len(candidate)) / (2 ** zeros * k) / total
        elif hits == 0:
            continue  # one token only: nothing to smooth by, the order is left out
        else:
            precision = hits / total
        logs += math.log(precision) / max_n
    short = len(candidate) < len(reference)
    return math.exp(logs) * (math.exp(1 - len(reference) / len(candidate)) if short else 1.0)


def _words(text: str) -> list[str]:
    return "".join(c for c in text.lower() if c.isalnum() or c.isspace()).split()


def _chars(text: str) -> list[str]:
    return [c for c in text.lower() if c.isalnum()]


@F.pandas_udf(T.DoubleType())
def word_bleu(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """G21. BLEU-4 over lower-case alphanumeric words; NULL when a side is NULL."""
    return pd.Series([None if a is None or b is None else bleu(_words(a), _words(b))
                      for a, b in zip(candidate, reference)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def char_bleu(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """G22. BLEU-4 over lower-case alphanumeric characters; NULL when a side is NULL."""
    return pd.Series([None if a is None or b is None else bleu(_chars(a), _chars(b))
                      for a, b in zip(candidate, reference)], dtype="float64")
