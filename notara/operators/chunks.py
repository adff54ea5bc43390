"""Overlapping windows of words or tokens."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..schemas import SPAN

_WORD = re.compile(r"\S+")


def check(size: int, overlap: int) -> int:
    """The step between windows; ValueError for sizes that make no progress."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"window of {size} with overlap {overlap}")
    return size - overlap


def window_starts(n: Column, size: int, overlap: int) -> Column:
    """Starts of the windows over n items: the last window is the first that reaches the end."""
    step = check(size, overlap)
    last = F.ceil(F.greatest(n - size, F.lit(0)) / step).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def chunk_spans(text: str, size: int, overlap: int) -> list[dict]:
    """Code point spans of the windows of `size` words over a text; the last is the first that reaches the end."""
    words = [m.span() for m in _WORD.finditer(text)]
    step, out = check(size, overlap), []
    for first in range(0, len(words), step):
        last = min(first + size, len(words))
        out.append({"start": words[first][0], "end": words[last - 1][1]})
        if last == len(words):
            break
    return out


def word_chunks(docs: DataFrame, size: int = 300, overlap: int = 50, keys: tuple[str, ...] = ("document_id",), text: str = "text", keep_text: bool = True) -> DataFrame:
    """(keys, chunk, start, end, chunk_text): chunks of whole words with code point offsets, no shuffle.

    Words are runs that are not white space; texts without words give no row.  Only the chunks' spans
    leave Python, not the words'.
    """
    check(size, overlap)
    spans = pandas_udf(lambda texts: texts.map(lambda t: chunk_spans(t or "", size, overlap)), T.ArrayType(SPAN))
    out = docs.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("_text"), F.posexplode(spans(text)).alias("chunk", "_s")).select(*keys, "chunk", "_text", "_s.start", "_s.end")
    return out.drop("_text") if not keep_text else out.select(*keys, "chunk", "start", "end", F.substring("_text", F.col("start") + 1, F.col("end") - F.col("start")).alias("chunk_text"))


def token_windows(rows: DataFrame, n: str, size: int = 320, overlap: int = 64) -> DataFrame:
    """rows exploded to one row for each window of n tokens: window, token_start, token_end."""
    return rows.select("*", F.posexplode(window_starts(F.col(n), size, overlap)).alias("window", "token_start")).withColumn("token_end", F.least(F.col("token_start") + size, F.col(n)))
