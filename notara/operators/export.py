"""Training samples: joining specs with notes, splits without leakage, windows of tokens, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import aligned, split_bucket
from ..schemas import ENTITY_TYPES
from ..tables import save
from .chunks import window_starts

VALIDATION_BUCKETS = 2_000  # of 10,000


def join_specs(specs: DataFrame, notes: DataFrame, order: str = "ordinal", ties: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Specs with their note, and specs without one; the last note of a case wins, of several the first by the columns of `ties`."""
    last = notes.withColumn("_r", F.row_number().over(W.partitionBy("case_id").orderBy(F.desc(order), *ties))).where("_r = 1").drop("_r", order, *ties)
    return specs.join(last, "case_id"), specs.join(last, "case_id", "left_anti")


def signature(candidates: Column, texts: Column) -> Column:
    """What must not be in both splits: the sorted distinct candidates, or else the sorted texts."""
    ids = F.array_sort(F.array_distinct(F.flatten(candidates)))
    return F.when(F.size(ids) > 0, F.array_join(ids, "|")).otherwise(F.array_join(F.array_sort(texts), "|"))


def split(signature: str | Column) -> Column:
    return F.when(split_bucket(signature) < VALIDATION_BUCKETS, "val").otherwise("train")


def split_manifest(samples: DataFrame) -> DataFrame:
    """One row: total, train, val and their ratios (four places) of samples(split)."""
    n = F.count("*")
    train, val = F.count_if(F.col("split") == "train"), F.count_if(F.col("split") == "val")
    return samples.agg(n.alias("total"), train.alias("train"), val.alias("val"), F.round(train / F.greatest(n, F.lit(1)), 4).alias("train_ratio"), F.round(val / F.greatest(n, F.lit(1)), 4).alias("val_ratio"))


def seeded_split(rows: DataFrame, ratio: float, seed: int, key: str = "id") -> DataFrame:
    """rows with split: the eval part has round-half-even(n * ratio) rows, at least 1 and at most n - 1 (none if ratio is 0).

    Rows are ordered by a seeded hash, then by key; a row whose key and hash another row has too counts
    for itself.  Counts of hash ranges find the range in which the eval part ends, and only that is sorted.
    """
    n = rows.count()
    if ratio and n < 2:
        raise ValueError("a split needs two rows")
    wanted = 0 if not ratio else min(n - 1, max(1, round(n * ratio)))
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    if not wanted:
        return hashed.drop("_h").withColumn("split", F.lit("train"))
    bins = max(1, int(n**0.5))
    width = (1 << 64) // bins + 1
    place = F.floor((F.col("_h").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)")).cast("long")
    before, last = 0, 0
    for b, k in sorted((r[0], r[1]) for r in hashed.groupBy(place).count().toLocalIterator()):
        last = b
        if before + k >= wanted:
            break
        before += k
    ends = hashed.where(place == last).select("_h", key).orderBy("_h", key).limit(wanted - before).agg(F.max(F.struct("_h", key))).first()[0]
    chosen = (F.col("_h") < ends[0]) | ((F.col("_h") == ends[0]) & (F.col(key) <= F.lit(ends[1])))
    return hashed.withColumn("split", F.when(chosen, "eval").otherwise("train")).drop("_h")


def char_spans(entities: str = "entities") -> Column:
    return F.transform(entities, lambda e: F.struct(F.get(e["position"], F.lit(0)).alias("start"), F.get(e["position"], F.lit(1)).alias("end"), e["type"].alias("label")))


def label_counts(samples: DataFrame) -> DataFrame:
    return samples.select(F.explode("ner").alias("e")).groupBy(F.col("e.label").alias("label")).agg(F.count("*").alias("n"))


def dry_run_stats(samples: DataFrame) -> DataFrame:
    """One row: samples, entities, and the most tokens of one of samples(tokenized_text, ner)."""
    return samples.agg(F.count("*").alias("samples"), F.coalesce(F.sum(F.size("ner")), F.lit(0)).alias("entities"), F.coalesce(F.max(F.size("tokenized_text")), F.lit(0)).alias("most_tokens"))


def document_samples(docs: DataFrame, size: int = 320, overlap: int = 64, types: tuple[str, ...] = ENTITY_TYPES) -> DataFrame:
    """(document_id, error, error_index, samples) of docs(document_id, raw_text, entities array<struct<text,start,end,entity_type>>).

    Texts are normalized and tokenized; entities become inclusive token spans of the windows that
    hold them whole.  The first fault of a document, in the order of the checks, fails it; windows
    without an entity are dropped.  Everything after the Arrow function is one row's arrays.
    """
    entities = F.coalesce("entities", F.array().cast(docs.schema["entities"].dataType))
    said = F.transform(entities, lambda e: F.struct(e["text"].alias("text"), e["start"].cast("int").alias("start"), e["end"].cast("int").alias("end")))
    base = docs.withColumn("entities", entities).withColumn("_n", aligned("raw_text", said))
    placed = F.transform("entities", lambda e, i: F.struct(e.alias("e"), i.alias("i"), *[F.get("_n.placed", i)[c].alias(c) for c in ("ns", "ne", "ts", "te", "raw", "same")]))
    two = base.withColumns({"_placed": placed, "_tokens": F.col("_n.tokens"), "_length": F.length("raw_text")})
    e = lambda m: m["e"]
    fault = lambda m: (
        F.when(e(m).isNull(), "invalid_entity_type")
        .when(e(m)["text"].isNull() | (e(m)["text"] == ""), "invalid_entity_text")
        .when(F.trim(F.coalesce(e(m)["entity_type"], F.lit(""))) == "", "invalid_entity_label")
        .when(~e(m)["entity_type"].isin(*types) if types else F.lit(False), "invalid_entity_type")
        .when(e(m)["start"].isNull() | e(m)["end"].isNull() | (e(m)["start"] < 0) | (e(m)["start"] >= e(m)["end"]), "invalid_raw_span")
        .when(e(m)["end"] > F.col("_length"), "raw_span_out_of_bounds")
        .when(~m["raw"], "raw_text_mismatch")
        .when(m["ns"].isNull(), "entity_removed_by_normalization")
        .when(~m["same"], "normalized_text_mismatch")
        .when(m["ts"].isNull() | m["te"].isNull(), "token_alignment_error")
    )
    three = two.withColumn("_faults", F.transform("_placed", lambda m: F.struct(fault(m).alias("f"), m["i"].alias("i"))))
    first = F.get(F.filter("_faults", lambda x: x["f"].isNotNull()), F.lit(0))
    spans = F.transform("_placed", lambda m: F.struct(m["ts"].alias("start"), m["te"].alias("end"), e(m)["entity_type"].alias("label")))
    four = three.withColumns({"_first": first, "_spans": spans, "_starts": window_starts(F.size("_tokens"), size, overlap)})
    held = lambda s: F.filter("_spans", lambda x: (x["start"] >= s) & (x["end"] < s + size))
    windows = F.filter(F.transform("_starts", lambda s: F.struct(
        F.slice("_tokens", s + 1, F.lit(size)).alias("tokenized_text"),
        F.transform(held(s), lambda x: F.struct((x["start"] - s).alias("start"), (x["end"] - s).alias("end"), x["label"].alias("label"))).alias("ner"),
    )), lambda w: F.size(w["ner"]) > 0)
    uncovered = F.exists("_spans", lambda x: ~F.exists("_starts", lambda s: (x["start"] >= s) & (x["end"] < s + size)))
    error = (
        F.when(F.col("document_id").isNull() | F.col("raw_text").isNull(), "invalid_document")
        .when(F.col("_n.length") == 0, "empty_normalized_text")
        .when(F.size("_tokens") == 0, "no_tokens")
        .when(F.col("_first").isNotNull(), F.col("_first.f"))
        .when(F.size(F.array_distinct("_spans")) < F.size("_spans"), "duplicate_entity")
        .when(uncovered, "entity_not_covered")
        .when(F.size(F.coalesce("entities", F.array())) == 0, "no_training_chunks")
    )
    five = four.withColumns({"error": error, "error_index": F.col("_first.i")})
    return five.select("document_id", "error", "error_index", F.when(F.col("error").isNull(), windows).alias("samples"))


class InvalidDocument(ValueError):
    """The first invalid document of a build that is to stop there."""


def build_samples(docs: DataFrame, errors: str | None = None, on_error: str = "skip", size: int = 320, overlap: int = 64, types: tuple[str, ...] = ENTITY_TYPES) -> tuple[DataFrame, DataFrame]:
    """Training samples (id, tokenized_text, ner) of the sound documents, and the errors (document_id, code, entity_index).

    errors: a path for the error rows as JSON lines, written before anything is raised.  on_error
    `raise` stops with InvalidDocument if there is any error, `skip` leaves those documents out whole.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    out = save(document_samples(docs, size, overlap, types), "samples")
    bad = out.where("error IS NOT NULL").select("document_id", F.col("error").alias("code"), F.col("error_index").alias("entity_index"))
    if errors is not None:
        bad.write.mode("overwrite").option("ignoreNullFields", "false").json(errors)
    first = bad.orderBy("document_id").first() if on_error == "raise" else None
    if first is not None:
        raise InvalidDocument(f"{first['document_id']}: {first['code']} (entity {first['entity_index']})")
    windows = out.where("error IS NULL").select("document_id", F.posexplode("samples").alias("window", "s"))
    return windows.select(F.concat_ws("#", "document_id", "window").alias("id"), "s.*"), bad
