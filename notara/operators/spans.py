"""Post-processing of predicted spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import slices, span_to_raw


def best_of_duplicates(predictions: DataFrame, key: str = "document_id") -> DataFrame:
    """One row for each (document, start, end, entity_type): the most confident (ties: least ord); first_ord is the group's least ord."""
    same = W.partitionBy(key, "start", "end", "entity_type")
    ranked = predictions.withColumns({"_rank": F.row_number().over(same.orderBy(F.desc("confidence"), "ord")), "first_ord": F.min("ord").over(same)})
    return ranked.where("_rank = 1").drop("_rank")


def resolve_overlaps(spans: DataFrame, key: str = "document_id") -> DataFrame:
    """Greedy choice in each document: most confident, then longest, then first_ord; no two chosen spans overlap.

    Spans that do not overlap, directly or through others, do not concern each other: a running maximum
    of ends cuts a document into runs, a run of one span is done, and a fold in one row chooses within
    each longer run.
    """
    rest = [c for c in spans.columns if c != key]
    by_start = W.partitionBy(key).orderBy("start", "end", "first_ord")
    reached = F.max("end").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    opens = spans.withColumn("_opens", F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1)))
    runs = opens.withColumn("_run", F.sum("_opens").over(by_start.rowsBetween(W.unboundedPreceding, 0)))
    order = F.struct((-F.col("confidence")).alias("c"), (F.col("start") - F.col("end")).alias("l"), "first_ord", F.struct(*rest).alias("row"))
    folded = F.aggregate(
        F.col("_all"),
        F.expr("transform(slice(_all, 1, 0), x -> x.row)"),
        lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["row"]["end"]) & (x["row"]["start"] < y["end"])), acc).otherwise(F.array_append(acc, x["row"])),
    )
    chosen = F.when(F.size("_all") == 1, F.transform("_all", lambda x: x["row"])).otherwise(folded)
    return runs.groupBy(key, "_run").agg(F.sort_array(F.collect_list(order)).alias("_all")).select(key, F.explode(chosen).alias("row")).select(key, "row.*")


def keep_confident(spans: DataFrame, least: float = 0.3) -> DataFrame:
    return spans.where(F.col("confidence") >= least)


def to_raw_offsets(spans: DataFrame, texts: DataFrame, key: str = "document_id") -> DataFrame:
    """Spans in raw offsets with the raw text in them; texts(key, raw_text, map).  Bad spans go.

    A document's spans meet its text and map in one row, so neither is copied for each span.
    """
    rest = [c for c in spans.columns if c not in (key, "start", "end", "text")]
    per = spans.groupBy(key).agg(F.collect_list(F.struct(*rest, "start", "end")).alias("_spans")).join(texts.select(key, "raw_text", "map"), key)
    placed = F.transform("_spans", lambda x: F.struct(x.alias("x"), span_to_raw("map", x["start"], x["end"]).alias("raw")))
    good = per.select(key, "raw_text", F.filter(placed, lambda y: y["raw"].isNotNull()).alias("_good")).withColumn("_texts", slices("raw_text", F.transform("_good", lambda y: y["raw"])))
    said = F.transform("_good", lambda y, i: F.struct(
        *[y["x"][c].alias(c) for c in rest], y["x"]["start"].alias("normalized_start"), y["x"]["end"].alias("normalized_end"), y["raw"]["start"].alias("start"), y["raw"]["end"].alias("end"),
        F.get("_texts", i).alias("text"),
    ))
    return good.select(key, said.alias("_said")).select(key, F.explode("_said").alias("s")).select(key, "s.*")


def postprocess(predictions: DataFrame, texts: DataFrame | None = None, least: float = 0.3, key: str = "document_id") -> DataFrame:
    """Duplicates, weak spans and overlaps go; offsets become raw if texts are given.

    The confidence filter stands first: a weak span never displaces a stronger one.
    """
    chosen = resolve_overlaps(best_of_duplicates(keep_confident(predictions, least), key), key)
    return chosen if texts is None else to_raw_offsets(chosen, texts, key)
