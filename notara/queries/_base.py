"""Registry of queries and their DuckDB SQL."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.text import lists_of
from ..schemas import DOUBLE, INT, STRING, struct
from ..tables import bound_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register f(read) -> DataFrame, where read(table) gives a table of the data set."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return add


def notes(read) -> DataFrame:
    """documents as notes(document_id, text)."""
    return read("documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")


#: A lexicon for the synthetic prose: word, entity type, score.
LEXICON = {"und": ("CHẨN_ĐOÁN", 0.9), "der": ("THUỐC", 0.7), "the": ("TRIỆU_CHỨNG", 0.8), "of": ("CHẨN_ĐOÁN", 0.6), "and": ("THUỐC", 0.55), "le": ("TRIỆU_CHỨNG", 0.5), "que": ("CHẨN_ĐOÁN", 0.45), "from": ("THUỐC", 0.25)}
VALUES = ", ".join(f"('{w}', '{t}', {s})" for w, (t, s) in LEXICON.items())

#: SQL of the lexicon's hits, by word number: the same words as in lexicon_hits().
HITS = rf"""
lex(word, entity_type, confidence) AS (VALUES {VALUES}),
words AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS w FROM documents)),
placed AS MATERIALIZED (SELECT doc_id, word, i, (sum(length(word)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS "end" FROM words),
hits AS MATERIALIZED (SELECT p.doc_id::VARCHAR AS document_id, p.i AS ord, p.word AS text, l.entity_type, p."end" - length(p.word) AS start, p."end", l.confidence::DOUBLE AS confidence FROM placed p JOIN lex l ON lower(p.word) = l.word)"""


_PIECE = regex.compile(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+")
_ASCII_PIECE = re.compile(r"\w+|\W+")


def _hits(text: str) -> list[tuple[int, int, int, str]]:
    """(ord, start, end, word) of the lexicon's words in a text."""
    pieces = (_ASCII_PIECE if text.isascii() else _PIECE).findall(text)
    found = [i for i, w in enumerate(map(str.lower, pieces)) if w in LEXICON]
    ends = list(accumulate(map(len, pieces))) if found else []
    return [(i + 1, ends[i] - len(pieces[i]), ends[i], pieces[i]) for i in found]


def _find(batches):
    for batch in batches:
        ids, texts, kinds, scores, places = [], [], [], [], array("i")
        for d, text in zip(batch.column("document_id"), batch.column("text"), strict=True):
            d = d.as_py()
            for i, start, end, word in _hits(text.as_py() or ""):
                kind, score = LEXICON[word.lower()]
                ids.append(d)
                texts.append(word)
                kinds.append(kind)
                scores.append(score)
                places.extend((i, start, end))
        at = np.array(places, np.int32).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(at[:, 0]), pa.array(texts, pa.string()), pa.array(kinds, pa.string()), pa.array(at[:, 1]), pa.array(at[:, 2]), pa.array(scores, pa.float64())],
            names=["document_id", "ord", "text", "entity_type", "start", "end", "confidence"],
        )


def lexicon_hits(read) -> DataFrame:
    """(document_id, ord, text, entity_type, start, end, confidence): words of the lexicon in whole texts, with offsets."""
    return notes(read).mapInArrow(_find, "document_id string, ord int, text string, entity_type string, start int, end int, confidence double")


@arrow_udf(T.ArrayType(struct(ord=INT, start=INT, end=INT, text=STRING, entity_type=STRING, confidence=DOUBLE)))
def lexicon_words(texts: pa.Array) -> pa.Array:
    """The hits of a text beside it, by place: what needs both has them in one row."""
    kind = pa.struct([("ord", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("entity_type", pa.string()), ("confidence", pa.float64())])
    found = [[(i, start, end, word, *LEXICON[word.lower()]) for i, start, end, word in _hits(t.as_py() or "")] for t in texts]
    return lists_of(found, lambda held: pa.StructArray.from_arrays([pa.array([x[k] for own in held for x in own], kind.field(k).type) for k in range(6)], [f.name for f in kind]))
