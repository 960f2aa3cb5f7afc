"""Text scalars: accent stripping, tokenising, stop words, n-grams.

All built-in column functions (JVM-side); the optional stemmer is the only
Python hook, applied as an Arrow-batched pandas UDF on token arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import col_of

# Word tokens: runs of letters, digits and underscore in any script (the
# Unicode meaning of \w, identical in Java and RE2 regex engines).
TOKEN_RE = r"[\p{L}\p{N}_]+"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(accented, plain) characters for ``translate``, built by rule: every
    Latin letter whose compatibility decomposition is one base letter plus
    combining marks maps to that base letter."""
    src, dst = [], []
    for cp in list(range(0xC0, 0x250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(c) -> Column:
    src, dst = accent_table()
    return F.translate(col_of(c), src, dst)


def default_stop_words(language: str = "english") -> list[str]:
    """Spark ML's built-in stop-word list (needs an active session)."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover.loadDefaultStopWords(language)


def tokens(c, accents: bool = True) -> Column:
    """Lower-cased word tokens (accents stripped first by default)."""
    x = F.lower(col_of(c))
    if accents:
        x = strip_accents(x)
    return F.regexp_extract_all(x, F.lit(TOKEN_RE), 0)


def drop_stop(tok, stop: list[str] | None, min_len: int = 1) -> Column:
    """Tokens not in ``stop`` and at least ``min_len`` characters long."""
    arr = F.array(*[F.lit(s) for s in (stop or [])])
    if stop:
        return F.filter(col_of(tok), lambda t: (~F.array_contains(arr, t)) & (F.length(t) >= min_len))
    return F.filter(col_of(tok), lambda t: F.length(t) >= min_len)


def stem_udf(stem: Callable[[str], str]):
    """Wrap a per-word stemmer as a vectorised pandas UDF over token arrays."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _stem(col: pd.Series) -> pd.Series:
        return col.map(lambda ws: None if ws is None else [stem(w) for w in ws])
    return _stem


def tokenise(df: DataFrame, col: str, stop: list[str] | None = None, stem: Callable | None = None,
             out: str = "tokens", text_out: str | None = None, accents: bool = False) -> DataFrame:
    """lower -> word tokens -> stop words removed -> optional stem; also the
    tokens joined by single spaces (no trailing space) when ``text_out``."""
    t = drop_stop(tokens(col, accents), stop)
    d = df.withColumn(out, t)
    if stem is not None:
        d = d.withColumn(out, stem_udf(stem)(F.col(out)))
    if text_out:
        d = d.withColumn(text_out, F.array_join(F.col(out), " "))
    return d


def ngrams(tok, lo: int = 1, hi: int = 1) -> Column:
    """All word n-grams with lo <= n <= hi, joined by a space."""
    t = col_of(tok)
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(t)
            continue
        idx = F.sequence(F.lit(1), F.size(t) - n + 1)
        grams = F.transform(idx, lambda i: F.array_join(F.slice(t, i, n), " "))
        parts.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)
