"""The whole note pipeline: normalize, predict, post-process, assert, link, validate, serialize."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sentence_context
from ..operators import assertion, linking, ner, spans, validation
from ..schemas import DIAGNOSIS, DRUG, ENTITY_TYPES
from ..tables import save


@dataclass
class Pipeline:
    """Stages and their parts; every part can be replaced.

    The normalized notes, the model's predictions and the entities are each written once to the
    shared folder: the model runs once over a chunk, and everything after it reads its stored answer.
    """

    model: object
    labels: list[str] = field(default_factory=lambda: list(ENTITY_TYPES))
    ontologies: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)  # entity type: name, entries
    linkers: dict[str, dict] = field(default_factory=dict)  # entity type: more arguments of linking.link()
    drug_names: list[str] | None = None
    rules: tuple = assertion.RULES
    boundary: str = assertion.BOUNDARY
    verifier: object = None
    threshold: float = 0.5
    least_confidence: float = 0.3
    chunk_size: int = 300
    chunk_overlap: int = 50
    strict: bool = True
    include_text: bool = False

    def _entities(self, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        given = texts.select("document_id", "text")
        raw = save(ner.predict(given, self.model, self.labels, self.threshold, self.chunk_size, self.chunk_overlap), "predictions")
        failed = raw.where("error IS NOT NULL").groupBy("document_id").agg(F.min(F.struct("chunk", "error"))["error"].alias("failure"))
        found = raw.where("error IS NULL").drop("error")
        if self.drug_names is not None:
            found = found.unionByName(ner.drug_predictions(given, self.drug_names))
        best = spans.postprocess(ner.ordered(found), texts, self.least_confidence)
        kept = best.join(failed, "document_id", "left_anti")
        numbered = kept.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "first_ord", "text", "entity_type", "confidence", "source"))).alias("_e"))
        entities = numbered.select("document_id", F.posexplode("_e").alias("entity_index", "e")).select("document_id", "entity_index", "e.text", "e.entity_type", "e.start", "e.end", "e.confidence", "e.source")
        return save(entities.withColumn("candidates", F.array().cast("array<string>")), "entities"), failed

    def entities(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Entities in raw offsets of docs(document_id, raw_text), and the notes whose model failed (document_id, failure)."""
        return self._entities(save(ner.normalize_documents(docs), "notes"))

    def run(self, docs: DataFrame) -> DataFrame:
        """(note_id, output, error) of every note of docs(document_id, raw_text).

        output is the note's JSON; a note whose model failed or (strict) whose entities are not valid
        has an empty entity list there, and the error's type and message in error.
        """
        texts = save(ner.normalize_documents(docs), "notes")
        found, failed = self._entities(texts)
        asserted = assertion.detect(texts, found, self.rules, self.boundary, show=False)
        if self.verifier is not None:
            asserted = assertion.verify(asserted.join(texts.select("document_id", "raw_text"), "document_id"), self.verifier).drop("raw_text")
        full = asserted.drop("evidence", "assertion_confidence", "needs_verification", "assertion_source")
        if self.ontologies:
            full = save(full, "asserted")
            linkable = full.where(F.col("entity_type").isin(*self.ontologies))
            context = linkable.join(texts.select("document_id", "raw_text"), "document_id").withColumn("context", sentence_context("raw_text", "start", "end")).withColumn("query_id", F.struct("document_id", "entity_index"))
            links = {}
            for kind, (name, entries) in self.ontologies.items():
                own = context.where(F.col("entity_type") == kind).select("query_id", F.col("text").alias("mention"), "context")
                links[kind] = linking.link(own, entries, name, **self.linkers.get(kind, {})).select("query_id.*", "candidates")
            full = linking.route(full, links, ["document_id", "entity_index"])
        checked = validation.output_errors(full, types=tuple(self.labels), texts=texts)
        return validation.note_outputs(texts.select("document_id", "raw_text"), checked, failed, self.strict, self.include_text)


def default_types() -> dict[str, str]:
    """The ontology that each linkable type goes to."""
    return {DIAGNOSIS: "ICD10", DRUG: "RXNORM"}
