"""Command line: infer notes to JSON lines or a ZIP, package predictions, prepare samples, train, evaluate, generate and validate synthetic notes."""

from __future__ import annotations

import argparse
import importlib

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import export, metrics, models, ner, synth, training
from .plans.pipeline import Pipeline
from .schemas import DIAGNOSIS, DRUG
from .sources import datasets, readers, sinks
from .tables import save


def _load(name: str | None):
    """package.module:object, or the model that is not available."""
    if not name:
        return ner.Unavailable()
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _entries(spark: SparkSession, path: str, name: str):
    """An ontology: a mapping file (.json) or a table of entries."""
    return datasets.load_ontology(spark, path, name) if path.endswith(".json") else spark.read.parquet(path)


def infer(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = readers.read_text_notes(spark, a.input)
    if a.dry_run:
        docs.withColumnRenamed("document_id", "stem").transform(lambda d: readers.corpus_profile(d.withColumn("n", F.lit(1)), "stem", "raw_text")).show(truncate=False)
        return 0
    kinds = {DIAGNOSIS: ("ICD10", a.icd), DRUG: ("RXNORM", a.drug)}
    entries = {k: (n, save(_entries(spark, p, n), "ontology")) for k, (n, p) in kinds.items() if p}
    names = None
    if not a.disable_drug_rules and DRUG in entries:  # all of the catalog's, which workers hold
        names = [r[0] for r in entries[DRUG][1].select("name").distinct().toLocalIterator()]
    plan = Pipeline(_load(a.model), ontologies=entries, drug_names=names, threshold=a.threshold, least_confidence=a.min_confidence, chunk_size=a.chunk_size, chunk_overlap=a.chunk_overlap, include_text=a.include_text)
    results = save(plan.run(docs.select("document_id", "raw_text")), "results")
    if a.output.endswith(".zip"):
        sinks.write_zip(results, a.output)
    else:
        sources = docs.select(F.col("document_id").alias("note_id"), F.col("metadata")["source_path"].alias("source_path"))
        sinks.write_run(results, a.output, a.errors, sources)
    total = metrics.run_summary(results).first()
    print(f"total {total['total']}, succeeded {total['succeeded']}, failed {total['failed']}")
    return 1 if total["failed"] else 0


def package(spark: SparkSession, a: argparse.Namespace) -> int:
    print(sinks.package_predictions(spark, a.predictions, a.output))
    return 0


def _samples(spark: SparkSession, a: argparse.Namespace):
    """Training samples of labelled documents, or of contents and labels in two files."""
    docs = readers.load_documents(spark, a.documents)
    if a.labels:
        labels = readers.load_documents(spark, a.labels).select("document_id", F.col("entities_raw").alias("_own"))
        docs = readers.pair(docs, labels, "document_id", strict=True)[0].withColumn("entities_raw", F.col("_own"))
    entities = F.transform("entities_raw", lambda e: F.struct(e["text"].alias("text"), F.get(e["position"], F.lit(0)).alias("start"), F.get(e["position"], F.lit(1)).alias("end"), e["type"].alias("entity_type")))
    return export.build_samples(docs.select("document_id", "raw_text", entities.alias("entities")), a.errors, a.on_error, a.max_tokens, a.token_overlap)[0]


def prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    export.seeded_split(_samples(spark, a), a.ratio, a.seed).write.mode("overwrite").partitionBy("split").json(a.output)
    return 0


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.samples:
        rows = datasets.token_dataset(spark, a.samples).withColumn("id", F.xxhash64("tokenized_text", "ner"))
    else:
        rows = _samples(spark, a)
    rows = save(export.seeded_split(rows, a.ratio, a.seed), "samples")
    if a.dry_run:
        export.dry_run_stats(rows).show()
        return 0
    factory = _load(a.factory) if a.factory else lambda name: models.span_model(name, a.device)()
    config = training.TrainerConfig(model=a.model, output_dir=a.output, max_steps=a.max_steps)
    print(training.fine_tune(rows.where("split = 'train'"), rows.where("split = 'eval'"), config, factory))
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Marked notes against their specs: accepted cases by split, rejected ones with their errors, and the manifest."""
    specs, notes = spark.read.schema(synth.SPEC).json(a.specs), spark.read.json(a.notes)
    known = {k: _entries(spark, p, n) for k, n, p in ((DIAGNOSIS, "ICD10", a.icd), (DRUG, "RXNORM", a.drug)) if p}
    good, bad = synth.export_cases(specs, notes, known)
    good = save(good, "accepted")
    good.write.mode("overwrite").partitionBy("split").json(a.output)
    bad.write.mode("overwrite").json(a.rejected)
    export.split_manifest(good).show()
    return 0


def evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = readers.to_documents(readers.read_records(spark, a.gold).withColumn("line", F.monotonically_increasing_id())).where("has_labels")
    gold = readers.explode_entities(docs).select("document_id", F.get("position", F.lit(0)).alias("start"), F.get("position", F.lit(1)).alias("end"), "entity_type")
    found, _ = Pipeline(_load(a.model), threshold=a.threshold, least_confidence=a.min_confidence).entities(docs.select("document_id", "raw_text"))
    metrics.exact_scores(gold, found).show()
    metrics.overlap_scores(gold, found).show()
    return 0


def generate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Cases that pass go to output with their specs, the others to errors; a run that resumes skips the cases that are there."""
    specs = synth.generate_cases(spark, a.num_samples, a.seed, spark.read.parquet(a.surfaces))
    if a.resume:
        try:
            specs = specs.join(save(spark.read.schema("case_id string").json(a.output), "done"), "case_id", "left_anti")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    specs = save(specs, "specs")
    client = models.ChatClient(datasets.WriterConfig.from_env()) if a.llm else None
    notes = save(synth.render_cases(specs, client), "rendered")
    checked = save(synth.validate_cases(specs, notes), "checked")
    mode = "append" if a.resume else "overwrite"
    notes.join(checked.where(F.size("errors") == 0), "case_id", "left_semi").write.mode(mode).json(a.output)
    specs.write.mode(mode).json(f"{a.output.rstrip('/')}-specs")
    checked.where(F.size("errors") > 0).write.mode(mode).json(a.errors)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="notara")
    sub = p.add_subparsers(dest="command", required=True)
    for name, f, options in (
        ("infer", infer, {"--input": None, "--output": "predictions", "--errors": "errors", "--model": "", "--icd": "", "--drug": "", "--threshold": 0.5, "--min-confidence": 0.3, "--chunk-size": 300, "--chunk-overlap": 50}),
        ("package", package, {"--predictions": None, "--output": "output.zip"}),
        ("prepare", prepare, {"--documents": None, "--labels": "", "--output": "samples", "--errors": "errors", "--on-error": "skip", "--max-tokens": 320, "--token-overlap": 64, "--ratio": 0.1, "--seed": 42}),
        ("train", train, {"--samples": "", "--documents": "", "--labels": "", "--model": None, "--factory": "", "--device": "cpu", "--output": "models/ner", "--errors": "errors", "--on-error": "skip", "--max-tokens": 320, "--token-overlap": 64, "--ratio": 0.1, "--seed": 42, "--max-steps": 2_000}),
        ("validate", validate, {"--specs": None, "--notes": None, "--icd": "", "--drug": "", "--output": "accepted", "--rejected": "rejected"}),
        ("evaluate", evaluate, {"--gold": None, "--model": "", "--threshold": 0.5, "--min-confidence": 0.3}),
        ("generate", generate, {"--surfaces": None, "--output": "notes", "--errors": "generate-errors", "--num-samples": 50, "--seed": 42}),
    ):
        q = sub.add_parser(name)
        q.set_defaults(run=f)
        for flag, default in options.items():
            q.add_argument(flag, default=default, required=default is None, type=type(default) if default is not None else str)
        for flag in {"infer": ("--disable-drug-rules", "--dry-run", "--include-text"), "generate": ("--resume", "--llm"), "train": ("--dry-run",)}.get(name, ()):
            q.add_argument(flag, action="store_true")
    a = p.parse_args(argv)
    return a.run(SparkSession.builder.appName("notara").getOrCreate(), a)


if __name__ == "__main__":
    raise SystemExit(main())
