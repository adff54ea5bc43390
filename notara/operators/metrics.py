"""Scores of predicted entities and links against gold ones."""

from __future__ import annotations

from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..schemas import INT

KEY = ("document_id", "start", "end", "entity_type")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def scores(counts: DataFrame) -> DataFrame:
    """counts(tp, fp, fn) with precision, recall and f1; 0 where a denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def _counts(marked: DataFrame, by: tuple[str, ...]) -> DataFrame:
    g, p = F.coalesce("_g", F.lit(0)), F.coalesce("_p", F.lit(0))
    sums = [F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(n) for x, n in ((g * p, "tp"), (p * (1 - g), "fp"), (g * (1 - p), "fn"))]
    return marked.groupBy(*by).agg(*sums)


def exact_scores(gold: DataFrame, predicted: DataFrame, by: tuple[str, ...] = (), key: tuple[str, ...] = KEY) -> DataFrame:
    """Counts over the sets of keys, for all rows or for each value of `by`: both sides in one aggregation, no join."""
    unlike = lambda g: F.when(reduce(or_, [F.col(k).isNull() for k in key]), g).alias("_unlike")  # noqa: E731  (a null equals nothing of the other side)
    sides = [df.select(*key, F.lit(g).alias("_g"), F.lit(1 - g).alias("_p"), unlike(g)) for df, g in ((gold, 1), (predicted, 0))]
    both = sides[0].unionByName(sides[1]).groupBy(*key, "_unlike").agg(F.max("_g").alias("_g"), F.max("_p").alias("_p"))
    return scores(_counts(both, by))


def matched(gold: list[tuple[int, int]], predicted: list[tuple[int, int]]) -> int:
    """How many of the gold spans find a free predicted one, both sorted; a predicted span that ends before a gold start is done."""
    near: list[tuple[int, int]] = []
    n = at = 0
    for start, end in gold:
        while at < len(predicted) and predicted[at][0] < end:
            near.append(predicted[at])
            at += 1
        near = [y for y in near if y[1] > start]
        k = next((k for k, y in enumerate(near) if y[0] < end), None)
        if k is not None:
            del near[k]
            n += 1
    return n


@arrow_udf(INT)
def _matches(gold: pa.Array, predicted: pa.Array) -> pa.Array:
    spans = lambda own: [(x["start"], x["end"]) for x in own.as_py() if x["start"] is not None and x["end"] is not None]
    return pa.array([matched(spans(g), spans(p)) for g, p in zip(gold, predicted, strict=True)], pa.int32())


def overlap_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Counts for each entity type where a half-open overlap of the same type is a match, one to one.

    Our definition: in the order of gold starts, each gold entity takes the first predicted one that
    overlaps it and is free.  One pass over a document's entities of one type, both sides by their places.
    """
    span = F.sort_array(F.collect_set(F.struct("start", "end")))
    g = gold.groupBy("document_id", "entity_type").agg(span.alias("g"))
    p = predicted.groupBy("document_id", "entity_type").agg(span.alias("p"))
    both = g.join(p, ["document_id", "entity_type"], "full")
    empty = F.array().cast("array<struct<start:int,end:int>>")
    g_, p_ = F.coalesce("g", empty), F.coalesce("p", empty)
    counted = both.select("entity_type", F.size(g_).alias("_g"), F.size(p_).alias("_p"), _matches(g_, p_).alias("tp"))
    rows = counted.select("entity_type", "tp", (F.col("_p") - F.col("tp")).alias("fp"), (F.col("_g") - F.col("tp")).alias("fn"))
    return scores(rows.groupBy("entity_type").agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn")]))


def linking_scores(gold: DataFrame, results: DataFrame, key: list[str], ks: tuple[int, ...] = (1, 5, 10, 20, 30)) -> DataFrame:
    """One row: total, top1_accuracy, recall_at_k, mrr, selection_coverage of results(key, candidates, selected_code) for gold(key, gold_code)."""
    at = F.coalesce(F.array_position("candidates", F.col("gold_code")), F.lit(0))
    rows = gold.join(results, key, "left").withColumn("_at", at)
    n = F.greatest(F.count("*"), F.lit(1))
    share = lambda cond: F.coalesce(F.sum(F.when(cond, 1.0).otherwise(0.0)), F.lit(0.0)) / n
    return rows.agg(
        F.count("*").alias("total"),
        share(F.col("selected_code") == F.col("gold_code")).alias("top1_accuracy"),
        *[share((F.col("_at") > 0) & (F.col("_at") <= k)).alias(f"recall_at_{k}") for k in ks],
        (F.coalesce(F.sum(F.when(F.col("_at") > 0, 1.0 / F.col("_at")).otherwise(0.0)), F.lit(0.0)) / n).alias("mrr"),
        share(F.col("selected_code").isNotNull()).alias("selection_coverage"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """total, succeeded, failed of results(error)."""
    return results.agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))
