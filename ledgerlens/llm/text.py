"""Words, shingles and row keys shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bounds of what separates words: blank and the ASCII control blanks (regular-expression class).
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"

SHINGLE_WORDS = 5

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fingerprint(*columns: Column) -> Column:
    """64-bit hash that tells rows of one id apart (repeated equal rows share it)."""
    return F.xxhash64(*columns)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all others."""
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    h = (h ^ (h >> np.uint64(27))) * _MIX
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of every word, A-Z in lower case.  ``bytes.split`` and
    ``bytes.lower`` treat exactly the ASCII blanks and letters."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word shingles.  Fewer words
    make one shingle of the whole sequence; no words, none."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        h = mixed(h * _MIX + w[i:i + n])
    return np.unique(h)


def null_safe(column: Column) -> Column:
    """A grouping and join key for a nullable string: null sorts after every value."""
    return F.concat(F.when(column.isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce(column, F.lit("")))
