"""Training data sets, catalogs and ontology mapping files."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validation import sample_errors
from . import readers

SAMPLE = "tokenized_text array<string>, ner array<struct<start:int,end:int,label:string>>"
MENTIONS = "text string, label array<struct<start:int,end:int,type:string>>"
SURFACE = "surface_id string, text string, entity_type string, candidates array<string>, concept_id string, tty string, profile string, reliability string, usable_for_ner boolean, usable_for_linking boolean"
#: Names of a catalog folder's tables.
CATALOGS = ("drug_surfaces", "disease_surfaces", "symptom_surfaces", "lab_tests", "hard_negatives")


def token_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Token samples of a .json array or .jsonl file: [start, end, label] lists or objects; ValueError on the first bad sample."""
    raw = "tokenized_text array<string>, ner array<array<string>>"
    rows = readers.read_records(spark, path, raw).select("tokenized_text", F.transform("ner", lambda x: F.struct(F.get(x, F.lit(0)).cast("int").alias("start"), F.get(x, F.lit(1)).cast("int").alias("end"), F.get(x, F.lit(2)).alias("label"))).alias("ner"))
    bad = sample_errors(rows).where("fault IS NOT NULL").select("fault").first()
    if bad:
        raise ValueError(f"{path}: {bad[0]}")
    return rows


def mention_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(id, text, label) of [[start, end, type]] lines, and the lines that do not parse."""
    good, bad = readers.json_lines(spark, path, "text string, label array<array<string>>", strict=False)
    span = F.transform(F.filter("label", lambda x: F.size(x) == 3), lambda x: F.struct(F.get(x, F.lit(0)).cast("int").alias("start"), F.get(x, F.lit(1)).cast("int").alias("end"), F.get(x, F.lit(2)).alias("type")))
    return good.select(F.col("line").alias("id"), "text", span.alias("label")), bad


def load_catalogs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a catalog folder; one that is absent is empty."""
    out = {}
    for name in CATALOGS:
        try:
            out[name] = spark.read.schema(SURFACE).json(f"{folder}/{name}.jsonl")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            out[name] = spark.createDataFrame([], SURFACE)
    return out


def write_catalogs(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write each table as <name>.jsonl and give the pool counts."""
    counts = None
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}.jsonl")
        n = df.agg(F.lit(name).alias("pool"), F.count("*").alias("n"))
        counts = n if counts is None else counts.union(n)
    return counts


_CONCEPT = "struct<code:string,name_vi:string,group_vi:string,rxcui:string,name:string,tty:string>"
_ITEM = f"array<struct<vn_mention:string,original_text:string,parsed:struct<drug_name:string>,selected_concept:{_CONCEPT}>>"


def load_ontology(spark: SparkSession, path: str, ontology: str) -> DataFrame:
    """Ontology rows of a mapping file {verified: [...], review: [...]}: ICD10 or RXNORM; verified items come first."""
    rows = spark.read.schema(f"verified {_ITEM}, review {_ITEM}").json(path, multiLine=True)
    items = rows.select(F.posexplode(F.concat(F.coalesce("verified", F.array().cast(_ITEM)), F.coalesce("review", F.array().cast(_ITEM)))).alias("ordinal", "i")).select("ordinal", "i.*")
    c = F.col("selected_concept")
    if ontology == "ICD10":
        one = items.select("ordinal", c["code"].alias("code"), c["name_vi"].alias("name"), c["group_vi"].alias("description"), F.explode(F.array("vn_mention", c["name_vi"])).alias("mention"))
    elif ontology == "RXNORM":
        one = items.select("ordinal", c["rxcui"].alias("code"), c["name"].alias("name"), c["tty"].alias("description"), F.explode(F.array("original_text", F.col("parsed.drug_name"), c["name"])).alias("mention"))
    else:
        raise ValueError(f"unknown ontology {ontology}")
    return readers.mapping_ontology(one, ontology)


def load_rxnorm(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Concepts of one JSON file for each term type, bare or under data, items or concepts; of equal (id, type, name) the last wins."""
    from ..functions.text import match_key
    from ..operators.catalog import last_wins

    out = None
    for n, (tty, path) in enumerate(files.items()):
        rows = spark.read.json(path, multiLine=True)
        for key in ("data", "items", "concepts"):
            if key in rows.columns and hasattr(rows.schema[key].dataType, "elementType"):
                rows = rows.select(F.explode(key).alias("x")).select("x.*")
                break
        one = readers.rxnorm_items(rows, tty).withColumns({"normalized_name": match_key("name"), "ordinal": F.lit(n * (1 << 40)).cast("long") + F.monotonically_increasing_id()})
        out = one if out is None else out.unionByName(one)
    return last_wins(out, ["concept_id", "tty", "normalized_name"], "ordinal").drop("ordinal")


@dataclass(frozen=True)
class WriterConfig:
    """Settings of the language model that may write sections."""

    url: str
    model: str
    key: str = ""
    timeout: float = 300.0
    max_tokens: int = 900
    temperature: float = 0.45
    repair_temperature: float = 0.15
    top_p: float = 0.9

    @classmethod
    def from_env(cls, prefix: str = "WRITER_", env: dict[str, str] | None = None) -> WriterConfig:
        """From <prefix>URL, <prefix>MODEL and optional ones; ValueError names the variable that is missing or bad."""
        env = dict(os.environ) if env is None else env
        values: dict = {}
        for name, kind in (("url", str), ("model", str), ("key", str), ("timeout", float), ("max_tokens", int), ("temperature", float), ("repair_temperature", float), ("top_p", float)):
            raw = env.get(prefix + name.upper())
            if raw is None or not raw.strip():
                if name in ("url", "model"):
                    raise ValueError(f"{prefix}{name.upper()} is not set")
                continue
            try:
                values[name] = kind(raw)
            except ValueError:
                raise ValueError(f"{prefix}{name.upper()}: {raw!r}") from None
        out = cls(**values)
        if out.timeout <= 0 or out.max_tokens <= 0 or not 0 <= out.temperature <= 2 or not 0 <= out.repair_temperature <= 2 or not 0 < out.top_p <= 1:
            raise ValueError("a setting is out of its range")
        return out
