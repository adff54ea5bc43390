"""Reading notes, labels and ontologies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import RAW_ENTITIES

# Names that a field may have; the first that a record has counts, even if it is null.
TEXT_FIELDS = ("text", "raw_text", "content", "document", "note")
ID_FIELDS = ("note_id", "document_id", "id", "record_id")
ENTITY_FIELDS = ("entities", "labels", "annotations")


def stem(path: str | Column = "path") -> Column:
    """File name without folder and suffix."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.element_at(F.split(c, "/"), -1), "\\.[^.]*$", "")


def first_present(columns: list[str], names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in columns), None)


def default_id(stem_: Column, number: Column) -> Column:
    return F.concat(stem_, F.lit("_"), F.lpad(number.cast("string"), 6, "0"))


def read_text_notes(spark: SparkSession, path: str, document_id: str | None = None) -> DataFrame:
    """One document for each file; a byte order mark goes; `error` marks blank files."""
    rows = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    text = F.regexp_replace("value", "^﻿", "")
    return rows.select((F.lit(document_id) if document_id else stem()).alias("document_id"), text.alias("raw_text"), F.create_map(F.lit("source_path"), F.col("path"), F.lit("source_format"), F.lit("txt"), F.lit("has_labels"), F.lit("false")).alias("metadata"), F.when(F.regexp_replace(text, "(?U)\\s+", "") == "", "blank_text").alias("error"))


def read_records(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Records of a .json (object or array) or .jsonl path; bad lines have _corrupt_record. Other suffixes: ValueError."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith(".jsonl"):
        return reader.json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record").withColumn("path", F.col("_metadata.file_path"))
    if path.endswith(".json"):
        return reader.json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))
    raise ValueError(f"{path}: .json, .jsonl or .txt expected")


def load_documents(spark: SparkSession, path: str, document_id: str | None = None) -> DataFrame:
    """Documents of a .txt, .json or .jsonl path by its suffix; document_id names the only document of a text file."""
    if path.endswith(".txt"):
        return read_text_notes(spark, path, document_id)
    if document_id is not None:
        raise ValueError("document_id is for a single text file")
    if path.endswith(".jsonl"):
        kinds = spark.read.json(path).drop("_corrupt_record").schema
        return to_documents(json_lines(spark, path, kinds)[0])
    return to_documents(read_records(spark, path).withColumn("line", F.monotonically_increasing_id() + 1))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value) of the lines that are not blank, numbered within their file (blank lines count).

    A file is one row until it is split, so the numbers need no sort of the table.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split(F.regexp_replace("value", "^﻿|\r", ""), "\n")).alias("line", "value"))
    return files.where(F.trim("value") != "").withColumn("line", F.col("line") + 1)


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Parsed records with path and line, and the lines that do not parse; strict: such lines fail the job."""
    parsed = numbered_lines(spark, path).withColumn("r", F.from_json("value", schema))
    bad = F.col("r").isNull() | ~F.regexp_like("value", F.lit("^\\s*\\{.*\\}\\s*$"))
    if strict:
        parsed = parsed.withColumn("r", F.when(bad & (F.trim("value") != ""), F.raise_error(F.concat(F.lit("bad line "), F.col("line").cast("string")))).otherwise(F.col("r")))
    return parsed.where(~bad).select("path", "line", "r.*"), parsed.where(bad).select("path", "line", "value")


def _raw_entities(records: DataFrame, name: str | None) -> Column:
    """The entities of a record by field name, whatever their order and integer type; null or absent: none."""
    none = F.array().cast(RAW_ENTITIES)
    kind = records.schema[name].dataType.elementType if name and hasattr(records.schema[name].dataType, "elementType") else None
    if not hasattr(kind, "names"):
        return none
    wanted = {"text": "string", "type": "string", "position": "array<int>", "assertions": "array<string>", "candidates": "array<string>"}
    one = lambda e: F.struct(*[(e[k] if k in kind.names else F.lit(None)).cast(v).alias(k) for k, v in wanted.items()])
    return F.coalesce(F.transform(name, one), none)


def to_documents(records: DataFrame, number: Column | str = "line", path: Column | str = "path") -> DataFrame:
    """document_id, raw_text, entities_raw, metadata (all other fields as JSON), has_labels, error of records with any of the field names."""
    own = records.columns
    text, id_, ents = first_present(own, TEXT_FIELDS), first_present(own, ID_FIELDS), first_present(own, ENTITY_FIELDS)
    c = lambda x: F.col(x) if isinstance(x, str) else x
    name = default_id(stem(c(path)), c(number))
    entities = _raw_entities(records, ents)
    rest = [x for x in own if x not in (text, id_, ents, "path", "line", "_corrupt_record")]
    raw = F.col(text) if text else F.lit(None).cast("string")
    return records.select(
        (F.coalesce(F.col(id_).cast("string"), name) if id_ else name).alias("document_id"),
        raw.alias("raw_text"),
        entities.alias("entities_raw"),
        (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("metadata"),
        (F.size(entities) > 0).alias("has_labels"),
        F.when(raw.isNull() | (F.trim(raw) == ""), "blank_text").alias("error"),
    )


def explode_entities(documents: DataFrame) -> DataFrame:
    """One row for each raw entity, with its place in the document."""
    return documents.select("document_id", "raw_text", F.posexplode("entities_raw").alias("entity_index", "e")).select("document_id", "raw_text", "entity_index", "e.text", F.col("e.type").alias("entity_type"), "e.position", "e.assertions", "e.candidates")


def pair(contents: DataFrame, labels: DataFrame, key: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Contents with their labels, and (key, side) of the ids that only one side has.

    strict: an id that is empty, repeated or on one side only is a ValueError that names the first ones.
    """
    if strict:
        for side, rows in (("contents", contents), ("labels", labels)):
            ids = rows.groupBy(key).agg(F.count("*").alias("n"))
            bad = [str(r[0]) for r in ids.where(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "") | (F.col("n") > 1)).orderBy(key).limit(10).collect()]
            if bad:
                raise ValueError(f"{side}: empty or repeated ids {bad}")
    missing = contents.join(labels, key, "left_anti").select(key, F.lit("labels").alias("missing_side")).union(labels.join(contents, key, "left_anti").select(key, F.lit("contents").alias("missing_side")))
    if strict:
        lost = {side: [r[0] for r in missing.where(F.col("missing_side") == side).orderBy(key).limit(10).collect()] for side in ("labels", "contents")}
        if any(lost.values()):
            raise ValueError(f"missing labels {lost['labels']}, missing contents {lost['contents']}")
    return contents.join(labels, key), missing


def repeated_ids(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def natural_order(name: str = "stem") -> list[Column]:
    """Sort keys: numeric stems first by their value, then others whatever their case."""
    numeric = F.regexp_like(name, F.lit("^[0-9]+$"))
    return [F.when(numeric, 0).otherwise(1), F.when(numeric, F.col(name).cast("decimal(38,0)")), F.lower(name), F.col(name)]


def corpus_profile(docs: DataFrame, key: str, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """One row: number of files and characters, first and last id."""
    by = F.struct(*(order or [key]))
    return docs.agg(F.count("*").alias("num_files"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("total_characters"), F.min_by(key, by).alias("first_id"), F.max_by(key, by).alias("last_id"))


def read_spreadsheet(spark: SparkSession, path: str, header_row: int = 4) -> DataFrame:
    """An ICD sheet (.xlsx by pandas on the driver; .csv and .parquet by Spark) with trimmed column names."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
    else:
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path, header=header_row, dtype=str))
    return df.toDF(*[c.strip() for c in df.columns])


def icd_concepts(sheet: DataFrame, code: str = "Mã", name: str = "Tên bệnh") -> DataFrame:
    from ..functions.text import clean_text, match_key

    rows = sheet.select(F.upper(clean_text(code)).alias("concept_id"), clean_text(name).alias("name_vi")).dropna()
    return rows.withColumn("normalized_name", match_key("name_vi"))


def rxnorm_items(records: DataFrame, tty: str) -> DataFrame:
    """(concept_id, name, tty) of items under any of the known keys; null-like values go."""
    from ..functions.text import clean_text

    def any_of(*names: str) -> Column:
        found = [F.col(n).cast("string") for n in names if n in records.columns]
        return reduce(lambda a, b: F.coalesce(a, b), found) if found else F.lit(None).cast("string")

    return records.select(clean_text(any_of("rxcui", "RXCUI")).alias("concept_id"), clean_text(any_of("name", "str", "concept_name")).alias("name"), F.coalesce(clean_text(any_of("tty", "TTY")), F.lit(tty)).alias("tty")).where("concept_id IS NOT NULL AND name IS NOT NULL")


def mapping_ontology(items: DataFrame, ontology: str) -> DataFrame:
    """Ontology rows of items(ordinal, code, name, description, mention): the first item of a code names it, all mentions are aliases."""
    rows = items.where("code IS NOT NULL AND trim(code) != ''")
    alias = F.sort_array(F.array_distinct(F.filter(F.collect_set(F.trim("mention")), lambda x: x != "")))
    first = F.min_by(F.struct("name", "description"), "ordinal")
    return rows.groupBy("code").agg(alias.alias("aliases"), first.alias("f")).select("code", F.coalesce(F.nullif(F.trim("f.name"), F.lit("")), F.col("code")).alias("name"), "aliases", F.coalesce("f.description", F.lit("")).alias("description"), F.lit(ontology).alias("ontology"))


def check_single_ontology(entries: DataFrame) -> str:
    """The only ontology of the entries; ValueError for none or several."""
    got = [r[0] for r in entries.select("ontology").distinct().limit(2).collect()]
    if len(got) != 1:
        raise ValueError("entries of exactly one ontology expected")
    return got[0]


def first_of_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
