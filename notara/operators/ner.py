"""Entity models over chunks, a lexicon model, and drug rules."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.text import normalization_info, normalized
from ..schemas import DRUG
from .chunks import word_chunks

SCHEMA = "document_id string, chunk int, start int, end int, text string, entity_type string, confidence double, source string"


class Unavailable:
    """Stands for a model that could not be loaded: every note fails."""

    def predict_entities(self, text, labels, **_):
        raise RuntimeError("the model is not available")


def normalize_documents(docs: DataFrame) -> DataFrame:
    """docs(document_id, raw_text) with text, map and metadata of the normalized text."""
    return docs.select("document_id", "raw_text", normalized("raw_text").alias("_n")).select("document_id", "raw_text", "_n.text", "_n.map").withColumn("metadata", normalization_info("raw_text", "text"))


def predict(docs: DataFrame, model: Callable[[], object] | object, labels: list[str], threshold: float = 0.5, size: int = 300, overlap: int = 50, isolate: bool = True) -> DataFrame:
    """Predictions over the chunks of docs(document_id, text) in the text's offsets, with `error` for chunks that failed.

    model is an object with predict_entities(text, labels, flat_ner, threshold, multi_label), or a
    function that makes one in each worker.  Spans out of the chunk and labels not asked for go.
    """
    chunks = word_chunks(docs, size, overlap)

    def run(batches):
        m = model() if callable(model) and not hasattr(model, "predict_entities") else model
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                try:
                    for p in m.predict_entities(r.chunk_text, labels, flat_ner=True, threshold=threshold, multi_label=False):
                        s, e = int(p["start"]), int(p["end"])
                        if 0 <= s < e <= len(r.chunk_text) and p["label"] in labels:
                            out.append((r.document_id, r.chunk, r.start + s, r.start + e, r.chunk_text[s:e], p["label"], float(p.get("score", 0.0)), "gliner", None))
                except Exception as x:
                    if not isolate:
                        raise
                    out.append((r.document_id, r.chunk, None, None, None, None, None, "gliner", f"{type(x).__name__}: {x}"))
            yield pd.DataFrame(out, columns=["document_id", "chunk", "start", "end", "text", "entity_type", "confidence", "source", "error"]).astype({"chunk": "Int32", "start": "Int32", "end": "Int32"})

    return chunks.mapInPandas(run, SCHEMA + ", error string")


class Lexicon:
    """A model of words with fixed labels and scores; needs no machine learning."""

    def __init__(self, words: dict[str, tuple[str, float]]):
        self.words = {w.lower(): v for w, v in words.items()}
        self.pattern = re.compile(r"(?<!\w)(?:" + "|".join(re.escape(w) for w in sorted(self.words, key=len, reverse=True)) + r")(?!\w)", re.I)

    def predict_entities(self, text, labels, flat_ner=True, threshold=0.5, multi_label=False):
        for m in self.pattern.finditer(text):
            label, score = self.words[m[0].lower()]
            if score >= threshold:
                yield {"start": m.start(), "end": m.end(), "text": m[0], "label": label, "score": score}


# Drug rules.  A line is a candidate inside a medication section or when it names a dose; a known
# name counts there, and in a section so does the word of a bulleted line before its dose.
_SECTION = re.compile(r"^\s*(?:\d+[.)]\s*)?(?:các\s+)?(?:thuốc|điều trị|medications?)(?!\w)", re.I)
_HEADING = re.compile(r"^\s*(?:\d+[.)]\s*\S|[^\W\d_][^:\n]{2,60}:?\s*$)")
_DOSE = re.compile(r"\d+(?:[.,]\d+)?\s*(?:mcg|mg|ml|g|%|viên|ui|iu)(?!\w)", re.I)
_CONTEXT = re.compile(r"(?<!\w)(?:po|iv|bid|tid|qid|qd|daily|scdc|sáng|trưa|chiều|tối)(?!\w)", re.I)
_BULLET = re.compile(r"^\s*[-*•+]\s*([^\W\d_][\w\- ]*?)\s+\d")
RULE_SCORE = 0.9


def drug_lines(text: str):
    """(start, line, inside a medication section) of each line."""
    at, section = 0, False
    for line in text.split("\n"):
        if _SECTION.search(line):
            section = True
        elif section and not _BULLET.search(line) and not line.lstrip().startswith(("-", "*", "•", "+")) and line.strip() and _HEADING.search(line) and not _DOSE.search(line):
            section = False
        yield at, line, section
        at += len(line) + 1


_TOKEN = re.compile(r"\w+|[^\w\s]")


class DrugNames:
    """Names by their first token, longest first: a line costs its tokens, however many names there are."""

    def __init__(self, names: list[str]):
        self.names: dict[str, list[str]] = {}
        for name in sorted({n.strip().lower() for n in names if n and n.strip()}, key=lambda n: (-len(n), n)):
            self.names.setdefault(_TOKEN.search(name)[0], []).append(name)

    def finditer(self, line: str):
        """(start, end) of the names in the line that stand between non-word characters, leftmost, then longest."""
        low, free = line.lower(), 0
        if len(low) != len(line):  # a letter whose lower case is longer
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
        for m in _TOKEN.finditer(low):
            at = m.start()
            if at < free or (at and _word(low[at - 1])):
                continue
            for name in self.names.get(m[0], ()):
                end = at + len(name)
                if low.startswith(name, at) and not (end < len(low) and _word(low[end])):
                    yield at, end
                    free = end
                    break


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def find_drugs(text: str, names: DrugNames) -> list[dict]:
    out = []
    for at, line, section in drug_lines(text):
        dosed = bool(_DOSE.search(line) or _CONTEXT.search(line))
        if not section and not dosed:
            continue
        taken = list(names.finditer(line))
        m = _BULLET.search(line) if section and dosed else None
        if m and not any(s < m.end(1) and m.start(1) < e for s, e in taken):
            taken.append(m.span(1))
        out += [{"start": at + s, "end": at + e, "text": line[s:e]} for s, e in sorted(taken)]
    return out


def drug_predictions(docs: DataFrame, names: list[str]) -> DataFrame:
    """Predictions of drugs by rules in docs(document_id, text); names: the ontology's names and brands (a catalog, held by each worker)."""
    known = DrugNames(names)

    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: find_drugs(t or "", known))

    found = docs.select("document_id", F.explode(pandas_udf(scan, "array<struct<start:int,end:int,text:string>>")("text")).alias("p"))
    return found.select("document_id", F.lit(-1).alias("chunk"), "p.start", "p.end", "p.text", F.lit(DRUG).alias("entity_type"), F.lit(RULE_SCORE).alias("confidence"), F.lit("drug_rules").alias("source"))


def ordered(predictions: DataFrame) -> DataFrame:
    """predictions with ord: their order in the document (model chunks first, then rules)."""
    from pyspark.sql import Window as W

    return predictions.withColumn("ord", F.row_number().over(W.partitionBy("document_id").orderBy(F.col("chunk") < 0, "chunk", "start", "end", "entity_type")) - 1)
