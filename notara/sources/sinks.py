"""Writing results."""

from __future__ import annotations

import json
import os
import sys
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import natural_order


def warn(message: str, stream=None) -> None:
    """Print a warning; characters that the stream can't write are escaped."""
    stream = stream or sys.stderr
    kind = getattr(stream, "encoding", None) or "utf-8"
    print("warning: " + message.encode(kind, "backslashreplace").decode(kind), file=stream)


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; Spark's commit protocol makes the write atomic."""
    df.write.mode("append" if append else "overwrite").json(path)


def check_paths(*paths: str) -> None:
    """Output paths must differ."""
    if len({os.path.normpath(p) for p in paths}) != len(paths):
        raise ValueError("output paths must differ")


def error_rows(results: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(note_id, source_path, error_type, message) of the results(note_id, error) that have an error `Type: message`."""
    bad = results.where("error IS NOT NULL").select("note_id", F.split("error", ": ", 2).alias("_e"))
    paths = bad.withColumn("source_path", F.lit(None).cast("string")) if sources is None else bad.join(sources.select("note_id", "source_path"), "note_id", "left")
    return paths.select("note_id", "source_path", F.get("_e", F.lit(0)).alias("error_type"), F.coalesce(F.get("_e", F.lit(1)), F.lit("")).alias("message"))


def write_run(results: DataFrame, predictions: str, errors: str, sources: DataFrame | None = None) -> None:
    """results(note_id, output, error): an output of every note in natural order, failed ones included, and the error rows.

    sources(note_id, source_path) names the files of notes.
    """
    check_paths(predictions, errors)
    results.select("note_id", "output").orderBy(*natural_order("note_id")).select("output").write.mode("overwrite").text(predictions)
    error_rows(results, sources).write.mode("overwrite").option("ignoreNullFields", "false").json(errors)


def write_zip(results: DataFrame, path: str, folder: str = "output") -> int:
    """One <folder>/<note_id>.json for each result in natural order; ids are non-empty, unique and no paths.

    The archive is one file by its nature: rows stream through the driver one partition at a time,
    after the ids have been checked by Spark, and it appears under its name only when it is complete.
    """
    named = results.select(F.coalesce("note_id", F.lit("")).alias("note_id"), "output")
    bad = named.groupBy("note_id").agg(F.count("*").alias("n")).where(F.col("note_id").isin("", ".", "..") | F.contains("note_id", F.lit("/")) | F.contains("note_id", F.lit("\\")) | (F.col("n") > 1)).first()
    if bad is not None:
        raise ValueError(f"{'repeated' if bad['n'] > 1 else 'bad'} note id {bad['note_id']!r}")
    n = 0
    with zipfile.ZipFile(f"{path}.tmp", "w", zipfile.ZIP_DEFLATED) as z:
        for r in named.orderBy(*natural_order("note_id")).toLocalIterator():
            z.writestr(f"{folder}/{r['note_id']}.json", json.dumps(json.loads(r["output"]), ensure_ascii=False, indent=2) + "\n")
            n += 1
    os.replace(f"{path}.tmp", path)
    return n


def package_predictions(spark: SparkSession, predictions: str, path: str, folder: str = "output") -> int:
    """write_zip() of a predictions file (or folder of files) of JSON lines; blank lines are skipped."""
    check_paths(predictions, path)
    lines = spark.read.text(predictions).where(F.trim("value") != "")
    return write_zip(lines.select(F.get_json_object("value", "$.note_id").alias("note_id"), F.col("value").alias("output")), path, folder)
