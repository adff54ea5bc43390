"""Exact duplicate texts by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 sets two bits of a blocked Bloom filter for each text hash and counts how often each bit is
hit; only bits hit at least twice stay.  Pass 2 tests every row: a text whose two bits do not both
stay occurs once and passes straight through; only the other rows shuffle, by their SHA-256.

The filter has 16 bits for each row at every size, in pages of 32,768 bits, and a hash's bits are in
one page.  Up to MOST_PAGES pages (32 MB, about 17 million rows) it is broadcast; a larger one is
joined by page, so that it never fills up.  Counting hits needs every row's two slots once: as merged
counts of (page, bit), not as whole bitmaps of each partition, since a partition of a large table has
few rows in each of very many pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import attach, read, row_hash, save

PAGE_BITS, MOST_PAGES, BITS_PER_ROW = 32_768, 8_192, 16


def normalised(text: str | Column = "text") -> Column:
    """text with each run of [\\x20\\x09-\\x0D] as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _bits(pages: int) -> list[Column]:
    """Page and two places in it, from the hash column h."""
    return [F.pmod("h", F.lit(pages)).alias("page"), (F.shiftrightunsigned("h", 20) % PAGE_BITS).alias("p1"), (F.shiftrightunsigned("h", 40) % PAGE_BITS).alias("p2")]


def repeated_filter(hashes: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """(page, bits) of the slots that at least two rows of hashes(h) hit, and the number of pages."""
    pages = max(1, -(-rows * BITS_PER_ROW // PAGE_BITS))
    slots = hashes.select(*_bits(pages)).select("page", F.explode(F.array_distinct(F.array("p1", "p2"))).alias("p"))
    twice = slots.groupBy("page", "p").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy("page").agg(F.bitmap_construct_agg("p").alias("bits")), pages


def possibly_repeated(rows: DataFrame, bits: DataFrame, pages: int) -> DataFrame:
    """rows (with the hash column h) and a boolean column `maybe`; false means that h occurs once."""
    page, p1, p2 = _bits(pages)
    held = bits.select(F.col("page").alias("_page"), F.col("bits").alias("_bits"))
    tested = rows.withColumns({"_page": page, "_p1": p1, "_p2": p2}).join(F.broadcast(held) if pages <= MOST_PAGES else held, "_page", "left")
    both = F.coalesce((_bit("_p1") == 1) & (_bit("_p2") == 1), F.lit(False))
    return tested.withColumn("maybe", both).drop("_page", "_p1", "_p2", "_bits")


def _bit(p: str) -> Column:
    """Bit p of the binary column _bits, 0 or 1 (null where there is no page)."""
    byte = f"cast(conv(hex(substring(_bits, cast({p} div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"shiftright({byte}, cast({p} % 8 as int)) & 1")


def text_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs(doc_id, text, ...).

    Texts are equal when normalised() makes them so; null is empty.  The row with the least doc_id
    of a group stays; null doc_ids come last, and of rows that repeat that doc_id the first read
    stays.  A long text is hashed where it is read and never shuffled.  An empty table gives an empty
    result; other columns of docs are ignored, whatever their names.
    """
    norm = normalised()
    rows = save(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.sha2(norm.cast("binary"), 256).alias("text_sha256"), F.xxhash64(norm).alias("h")), "texts")
    total = rows.count()
    tested = possibly_repeated(rows, *repeated_filter(rows, total))
    maybe = save(tested.where("maybe").drop("maybe", "h"), "maybe")
    once = tested.where("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    best = maybe.groupBy("text_sha256").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
    again = attach(maybe, save(best, "groups"), ["text_sha256"], "group_size", total).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
    return once.unionByName(again)


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts (least doc_id, null last, then the least row_hash()); all columns stay.

    Rows that occur once keep their place and, while the filter can be broadcast, are not shuffled.
    Null and empty texts are equal; an empty table gives an empty result; columns may have any name.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", row_hash(docs).alias("tie"), F.xxhash64(normalised()).alias("h"))
    total = docs.count()
    tested = possibly_repeated(rows, *repeated_filter(rows.select("h"), total))
    maybe = tested.where("maybe").drop("maybe").withColumn("_sha", F.sha2(normalised().cast("binary"), 256))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    best = maybe.groupBy("_sha").agg(F.min(order).alias("_best"), F.count("*").alias("_n"))
    first = attach(maybe, save(best, "groups"), ["_sha"], "_n", total).where(order == F.col("_best")).dropDuplicates(["_sha"])
    return tested.where("NOT maybe").select("doc.*").union(first.select("doc.*"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return text_groups(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
