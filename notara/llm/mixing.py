"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every copy of a document has a virtual finish time: the words of its source up to and including it,
in a shuffled order, divided by the source's target.  The mix is the copies in order of that time
until the total budget is used up.

Running sums are taken over blocks: a group of n rows is cut into about sqrt(n) blocks of about
sqrt(n) rows, so that no task sees a whole source or the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import read, row_hash, save, small

WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2


def n_words(text: str | Column = "text") -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, copies: int = MOST_COPIES) -> DataFrame:
    """(source, rank, n, source_size, target) of each source of sizes(source, n, source_size).

    Sources in order of code points, null last, take the weights in turn.  Together they get `share`
    of all words; a target stops at `copies` times its source's size and what is above is shared
    again by weight.  The window orders sources, not documents.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    full = ranked.withColumn("cap", F.col("source_size") * copies)
    # sources that reach their cap first, first; the level is what a unit of weight gets once those before are full
    by_need = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    rest = by_need.rowsBetween(0, W.unboundedFollowing)
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    filled = full.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    common = filled.withColumn("common", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every)["level"])
    return common.select("source", "rank", "n", "source_size", F.when(F.col("common").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight"))).alias("target"))


def _place(df: DataFrame, tie: str | None = None) -> list[Column]:
    """The shuffled order of df(doc_id, ...): MD5 of doc_id, doc_id, and the column `tie` or else the row's hash."""
    id_ = F.col("doc_id").cast("long")
    return [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"), F.coalesce(id_, F.lit(-(1 << 63))).alias("id"), (F.col(tie) if tie else row_hash(df)).alias("tie")]


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, copies: int = MOST_COPIES, tie: str | None = None) -> DataFrame:
    """rows(doc_id, source, size, ...) with source_size (long), target (double) and n_copies (0 to `copies`).

    Deterministic: documents are shuffled by the MD5 of their doc_id; ties go by doc_id, then by the
    column `tie` or else the row's hash; rows that are equal in everything count each for itself.  Null sources are a source
    of their own, and documents without words are never taken.  Columns may have any name; those
    named like the three new ones are replaced.  An empty table gives an empty result.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c.lower() not in ("source_size", "target", "n_copies")]
    about = targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), weights, share, copies)
    about = save(about.withColumnRenamed("source", "name").withColumn("bits", F.ceil(F.log2(F.greatest(F.sqrt("n"), F.lit(1.0)))).cast("int")), "targets")
    base = rows.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), "source", F.col("size").cast("long").alias("size"), *_place(rows, tie), F.monotonically_increasing_id().alias("nr"))
    place = F.expr("shiftright(cast(conv(substring(key, 1, 8), 16, 10) as bigint), 32 - bits)")
    keyed = base.join(small(spark, about), F.col("source").eqNullSafe(F.col("name"))).drop("name", "source").withColumn("block", place)
    keyed = save(keyed, "keyed")
    offsets = keyed.groupBy("rank", "block").agg(F.sum("size").alias("sum")).withColumn("before", F.sum("sum").over(W.partitionBy("rank").orderBy("block")) - F.col("sum")).drop("sum")
    within = W.partitionBy("rank", "block").orderBy("key", "id", "tie", "nr").rowsBetween(W.unboundedPreceding, 0)
    ranked = save(keyed.join(small(spark, offsets), ["rank", "block"]).withColumn("cum", F.col("before") + F.sum("size").over(within)), "ranked")
    finish = lambda e: (F.col("cum") + e * F.col("source_size")) / F.col("target")
    total, n = ranked.agg(F.sum("size"), F.count("*")).first()
    budget = (total or 0) * share
    bins = int(n**0.5) + 1
    flat = ranked.where("size > 0 AND target > 0").select("rank", "size", "key", "id", "tie", "nr", F.posexplode(F.array(*[finish(e) for e in range(copies)])).alias("e", "t"))
    flat = flat.withColumn("bin", F.floor(F.least("t", F.lit(4.0)) * bins))
    running = flat.groupBy("bin").agg(F.sum("size").alias("s")).withColumn("upto", F.sum("s").over(W.orderBy("bin")))
    last = running.where(F.col("upto") > budget).orderBy("bin").select("bin", F.col("upto") - F.col("s")).first()
    result = lambda taken: ranked.select("doc.*", "source_size", "target", taken.alias("n_copies"))
    if last is None:  # the budget holds every copy
        return result(F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(0))
    # only the bin in which the budget ends is sorted
    order = ["t", "rank", "key", "id", "tie", "nr", "e"]
    cut = flat.where(F.col("bin") == last[0]).withColumn("upto", F.sum("size").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) + last[1]).where(F.col("upto") <= budget).agg(F.max(F.struct(*order)).alias("cut")).select("cut.*").first()
    taken = F.lit(0)
    for e in range(copies):
        bin_, t = F.floor(F.least(finish(e), F.lit(4.0)) * bins), finish(e)
        upto = F.lit(False) if cut["t"] is None else F.struct(t, *order[1:-1], F.lit(e)) <= F.struct(*[F.lit(cut[c]).cast(flat.schema[c].dataType) for c in order])
        taken = taken + F.when((F.col("size") > 0) & (F.col("target") > 0) & ((bin_ < last[0]) | ((bin_ == last[0]) & upto)), 1).otherwise(0)
    return result(taken)


def mixed_documents(docs: DataFrame, **kinds) -> DataFrame:
    """The documents of the mix, a row for each copy, with the columns of docs; as many as mix() takes.

    Within a source the mix takes a prefix of the shuffled order for each copy, so one cut for each
    source and copy tells the copies of every row that has its place alone, and no text is shuffled.
    Rows that are equal in all columns share a place: one of them stands for all, with all their copies.
    """
    spark = docs.sparkSession
    rows = save(docs.select("doc_id", "source", n_words().alias("size"), *_place(docs)), "sizes")
    mixed = save(mix(rows, tie="tie", **kinds).select("source", "n_copies", F.struct("key", "id", "tie").alias("place")), "mixed")
    copies = kinds.get("copies", MOST_COPIES)
    cuts = mixed.groupBy(F.col("source").alias("_source")).agg(*[F.max(F.when(F.col("n_copies") > e, F.col("place"))).alias(f"_cut{e}") for e in range(copies)])
    shared = save(mixed.groupBy(F.col("place").alias("_place")).agg(F.count("*").alias("_rows"), F.sum("n_copies").cast("int").alias("_n")).where("_rows > 1"), "shared")
    doc = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("source").alias("_own"), F.struct(*_place(docs)).alias("_place"), n_words().alias("_size"))
    alone = doc.join(small(spark, shared.select("_place")), "_place", "left_anti").join(small(spark, cuts), F.col("_own").eqNullSafe(F.col("_source")))
    n = sum((F.coalesce((F.col("_size") > 0) & (F.col("_place") <= F.col(f"_cut{e}")), F.lit(False)).cast("int") for e in range(copies)), F.lit(0))
    repeated = doc.join(small(spark, shared), "_place").dropDuplicates(["_place"])
    every = alone.select("doc", n.alias("_n")).union(repeated.select("doc", "_n")).where("_n > 0")
    return every.select(F.explode(F.array_repeat("doc", F.col("_n"))).alias("doc")).select("doc.*")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    rows = save(read(spark, sf_dir, "documents").select("doc_id", "source", n_words().alias("size")), "sizes")
    return mix(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rk FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rk % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
c AS (SELECT *, (SELECT level FROM l WHERE level * weight < cap ORDER BY cap / weight, rk LIMIT 1) AS common FROM l),
t AS (SELECT source, rk, source_size, CASE WHEN common IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, common * weight) END AS target FROM c),
r AS (SELECT d.doc_id, d.size, t.rk, t.source_size, t.target, md5(coalesce(d.doc_id::VARCHAR, '')) AS k,
  sum(d.size) OVER (PARTITION BY t.rk ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, (cum + e * source_size)::DOUBLE / target AS vft FROM r, (VALUES (0), (1)) AS copies(e) WHERE size > 0 AND target > 0),
g AS (SELECT *, sum(size) OVER (ORDER BY vft, rk, k, doc_id, e ROWS UNBOUNDED PRECEDING) <= 1.5::DOUBLE * (SELECT sum(size) FROM d) AS ok FROM f),
n AS (SELECT doc_id, rk, sum(CASE WHEN ok THEN 1 ELSE 0 END) AS copies FROM g GROUP BY doc_id, rk)
SELECT r.doc_id, r.size, r.source_size, r.target, (r.size * coalesce(n.copies, 0))::BIGINT AS taken FROM r LEFT JOIN n ON r.doc_id = n.doc_id AND r.rk = n.rk
"""
