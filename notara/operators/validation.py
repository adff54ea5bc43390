"""Checks of entities, output and training samples, and serialization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import slices
from ..schemas import ASSERTION_TYPES, ASSERTIONS, CANDIDATE_TYPES, ENTITY_TYPES


def slice_of(text: str | Column, start: str | Column, end: str | Column) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.substring(c(text), c(start) + 1, c(end) - c(start))


def entity_errors(types: tuple[str, ...] = ENTITY_TYPES) -> Column:
    """First fault of a raw entity (columns raw_text, text, entity_type, position): null if it is sound."""
    start, end = F.get("position", F.lit(0)), F.get("position", F.lit(1))
    return (
        F.when(F.col("text").isNull() | F.col("entity_type").isNull() | F.col("position").isNull(), "missing_key")
        .when(~F.col("entity_type").isin(*types), "unknown_type")
        .when((F.size("position") != 2) | start.isNull() | end.isNull(), "bad_position")
        .when(~((start >= 0) & (start < end) & (end <= F.length("raw_text"))), "out_of_bounds")
        .when(slice_of("raw_text", start, end) != F.col("text"), "text_mismatch")
    )


def entity_set_errors(entities: DataFrame, key: str = "document_id") -> DataFrame:
    """entities with set_error: duplicate_key, or overlap with the entity before it (start, end, type order)."""
    w = W.partitionBy(key).orderBy("start", "end", "entity_type", "entity_index")
    same = W.partitionBy(key, "start", "end", "entity_type")
    return entities.withColumn("set_error", F.when(F.count("*").over(same) > 1, "duplicate_key").when(F.col("start") < F.lag("end").over(w), "overlap"))


def overlap_with_earlier(entities: DataFrame, key: str = "document_id") -> DataFrame:
    """entities with `overlaps`: whether any entity that starts earlier reaches into it; a running maximum, not a self-join."""
    w = W.partitionBy(key).orderBy("start", "end", "entity_index").rowsBetween(W.unboundedPreceding, -1)
    return entities.withColumn("overlaps", F.coalesce(F.max("end").over(w) > F.col("start"), F.lit(False)))


def output_errors(entities: DataFrame, key: str = "document_id", types=ENTITY_TYPES, labels=ASSERTIONS, linkable=CANDIDATE_TYPES, texts: DataFrame | None = None) -> DataFrame:
    """entities(raw_text, text, entity_type, start, end, assertions, candidates, entity_index) with errors and warnings (arrays).

    A span out of bounds ends an entity's checks after type and duplicate.  raw_text comes from
    texts(key, raw_text) if they are given: a document's entities then meet it in one row, and it is
    neither sorted nor copied for each of them.
    """
    same = W.partitionBy(key, "start", "end", "entity_type").orderBy("entity_index")
    rows = entities.withColumn("_again", F.row_number().over(same) > 1)
    if texts is not None:
        rest = [c for c in rows.columns if c != key]
        per = rows.groupBy(key).agg(F.collect_list(F.struct(*rest)).alias("_rows")).join(texts.select(key, "raw_text"), key)
        spans = F.transform("_rows", lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))
        said = per.select(key, F.length("raw_text").alias("_length"), F.explode(F.arrays_zip(F.col("_rows").alias("r"), slices("raw_text", spans).alias("s"))).alias("x"))
        rows = said.select(key, "x.r.*", F.col("x.s").alias("_said"), "_length")
    else:
        rows = rows.withColumns({"_said": slice_of("raw_text", "start", "end"), "_length": F.length("raw_text")})
    out = ~((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("_length")))
    unknown = F.sort_array(F.array_except("assertions", F.array(*map(F.lit, labels))))
    some = lambda *c: F.filter(F.array(*c), lambda x: x.isNotNull())
    errors = some(
        F.when(F.col("_again"), "duplicate"),
        F.when(~F.col("entity_type").isin(*types), "unknown_type"),
        F.when(out, "out_of_bounds"),
        F.when(~out & (F.col("_said") != F.col("text")), "text_mismatch"),
        F.when(~out & (F.size(unknown) > 0), F.concat(F.lit("unknown_assertions:"), F.array_join(unknown, ","))),
    )
    warnings = some(F.when(~out & ~F.col("entity_type").isin(*linkable) & (F.size("candidates") > 0), "candidates_dropped"))
    return rows.withColumns({"errors": errors, "warnings": warnings}).drop("_again", "_said", "_length")


def candidate_errors(entities: DataFrame, known: dict[str, DataFrame], key: str = "document_id") -> DataFrame:
    """(key, entity_index, error) of candidates that are no code of their type's ontology; known: entity type -> rows with `code`."""
    codes = None
    for kind, rows in known.items():
        own = rows.select(F.lit(kind).alias("entity_type"), F.col("code").cast("string").alias("code")).distinct()
        codes = own if codes is None else codes.unionByName(own)
    given = entities.where(F.col("entity_type").isin(*known)).select(key, "entity_index", "entity_type", F.explode("candidates").alias("code"))
    bad = given.join(codes, ["entity_type", "code"], "left_anti") if known else given.limit(0)
    return bad.select(key, "entity_index", F.concat(F.lit("unknown_candidate:"), "code").alias("error"))


def validate_documents(checked: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, valid, errors, warnings), messages in the order of the entities."""
    said = lambda c: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("entity_index", c))), lambda x: x[c]))
    rows = checked.groupBy(key).agg(said("errors").alias("errors"), said("warnings").alias("warnings"))
    return rows.withColumn("valid", F.size("errors") == 0)


def entity_json(labels: tuple[str, ...] = ASSERTION_TYPES, linkable: tuple[str, ...] = CANDIDATE_TYPES) -> Column:
    """JSON of an entity: assertions and candidates only for the types that have them."""
    kind = F.col("entity_type")
    return F.to_json(F.struct("text", kind.alias("type"), F.array("start", "end").alias("position"), F.when(kind.isin(*labels), F.col("assertions")).alias("assertions"), F.when(kind.isin(*linkable), F.col("candidates")).alias("candidates")))


def _text_json(c: str | Column) -> Column:
    """A string as a JSON string."""
    return F.regexp_replace(F.to_json(F.array(F.col(c).cast("string") if isinstance(c, str) else c)), "^\\[|\\]$", "")


def note_json(note_id: str, entities: Column, text: Column | None = None, problems: Column | None = None) -> Column:
    """JSON of a note from the array of its entities' JSON; with its text and its validation block where they are given."""
    parts = [F.lit('{"note_id":'), _text_json(note_id), F.lit(',"entities":['), F.array_join(entities, ","), F.lit("]")]
    if text is not None:
        parts += [F.lit(',"text":'), _text_json(text)]
    if problems is not None:
        parts.append(F.coalesce(F.concat(F.lit(',"validation":'), F.to_json(problems)), F.lit("")))
    return F.concat(*parts, F.lit("}"))


def _problems(errors: Column, warnings: Column) -> Column:
    """The validation block: null for a note without errors and warnings."""
    return F.when((F.size(errors) > 0) | (F.size(warnings) > 0), F.struct((F.size(errors) == 0).alias("valid"), errors.alias("errors"), warnings.alias("warnings")))


def _ordered(*order: str):
    """Aggregate of a column as an array in the order of other columns."""
    return lambda c, name: F.transform(F.sort_array(F.collect_list(F.struct(*order, c.alias("v")))), lambda x: x["v"]).alias(name)


def note_outputs(notes: DataFrame, checked: DataFrame, failed: DataFrame, strict: bool = True, include_text: bool = False, key: str = "document_id") -> DataFrame:
    """(note_id, output, error) of every row of notes(key, raw_text), in one aggregation of the entities.

    checked: output_errors() of all entities.  failed(key, failure): notes without a prediction.
    Those, and strict notes with errors, have an empty entity list, and `Type: message` as error.
    """
    by_place, by_index = _ordered("start", "end", "entity_index"), _ordered("entity_index")
    per = checked.withColumn("_j", entity_json()).groupBy(key).agg(by_place(F.col("_j"), "_js"), by_index(F.col("errors"), "_e"), by_index(F.col("warnings"), "_w"))
    rows = notes.select(key, *(["raw_text"] if include_text else [])).join(per, key, "left").join(failed.select(key, "failure"), key, "left")
    none = F.array().cast("array<string>")
    errors, warnings = F.coalesce(F.flatten("_e"), none), F.coalesce(F.flatten("_w"), none)
    wrong = F.when(F.lit(strict) & (F.size(errors) > 0), F.concat(F.lit("ValueError: "), F.array_join(errors, "; ")))
    rows = rows.withColumn("error", F.coalesce("failure", wrong))
    sound = F.col("error").isNull()
    output = note_json(key, F.when(sound, F.coalesce("_js", none)).otherwise(none), F.col("raw_text") if include_text else None, F.when(sound, _problems(errors, warnings)))
    return rows.select(F.col(key).alias("note_id"), output.alias("output"), "error")


def serialize(entities: DataFrame, key: str = "document_id", strict: bool = False, checked: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(note_id, output, error): JSON of the notes that have entities; strict notes with errors have an error instead.

    checked: validate_documents(); its errors and warnings become the note's validation block.
    texts(key, raw_text): the text goes along.
    """
    rows = entities.groupBy(key).agg(_ordered("start", "end", "entity_index")(entity_json(), "_js"))
    if texts is not None:
        rows = rows.join(texts.select(key, "raw_text"), key)
    text = None if texts is None else F.col("raw_text")
    if checked is None:
        return rows.select(F.col(key).alias("note_id"), note_json(key, F.col("_js"), text).alias("output"), F.lit(None).cast("string").alias("error"))
    joined = rows.join(checked.select(key, "errors", "warnings"), key, "left")
    none = F.array().cast("array<string>")
    errors, warnings = F.coalesce("errors", none), F.coalesce("warnings", none)
    bad = F.lit(strict) & (F.size(errors) > 0)
    return joined.select(F.col(key).alias("note_id"), F.when(~bad, note_json(key, F.col("_js"), text, _problems(errors, warnings))).alias("output"), F.when(bad, F.array_join(errors, "; ")).alias("error"))


def sample_errors(samples: DataFrame) -> DataFrame:
    """samples(tokenized_text, ner) with a fault: empty, bad_span, empty_label, duplicate; null if sound."""
    n = F.size("tokenized_text")
    fault = (
        F.when(F.col("tokenized_text").isNull() | (n <= 0), "empty")
        .when(F.exists("ner", lambda x: ~((x["start"] >= 0) & (x["start"] <= x["end"]) & (x["end"] < n))), "bad_span")
        .when(F.exists("ner", lambda x: F.trim(x["label"]) == ""), "empty_label")
        .when(F.size(F.array_distinct("ner")) < F.size("ner"), "duplicate")
    )
    return samples.withColumn("fault", fault)
