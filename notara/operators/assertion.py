"""Assertions (negated, historical, of the family) from cues whose scope contains an entity."""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..schemas import ASSERTION_TYPES, ASSERTIONS
from .models import first_object, generate


class Rule(NamedTuple):
    """A row of the cue table: a label, the cue's pattern, the confidence at no distance, and the side of the cue that its scope is on."""

    label: str
    pattern: str
    confidence: float
    side: str = "forward"


# Cue patterns, their confidence and direction; boundaries; scope and decay lengths.
RULES = (
    Rule("isNegated", r"\bkhông\s+(?:có|ghi nhận|thấy|phát hiện|bị|mắc)?\s*", 0.97),
    Rule("isNegated", r"\bchưa\s+(?:ghi nhận|thấy|phát hiện|từng|bị|mắc)?\s*", 0.94),
    Rule("isNegated", r"\b(?:chẳng|chả)\s+(?:có|thấy|bị)?\s*", 0.92),
    Rule("isNegated", r"\bphủ nhận\s+", 0.98),
    Rule("isNegated", r"\bâm tính(?:\s+với)?\s+", 0.96),
    Rule("isNegated", r"\bkhông còn\s+", 0.92),
    Rule("isNegated", r"\bloại trừ\s+", 0.72),
    Rule("isHistorical", r"\btiền sử(?:\s+(?:bị|mắc|có))?\s+", 0.98),
    Rule("isHistorical", r"\btrước đây(?:\s+đã)?(?:\s+từng)?\s+", 0.96),
    Rule("isHistorical", r"\bđã từng(?:\s+bị|\s+mắc|\s+có)?\s+", 0.96),
    Rule("isHistorical", r"\btừng(?:\s+bị|\s+mắc|\s+có)\s+", 0.91),
    Rule("isHistorical", r"\bcách đây\s+\d+(?:[,.]\d+)?\s*(?:ngày|tuần|tháng|năm)\b", 0.88, "backward"),
    Rule("isHistorical", r"\bhồi\s+(?:nhỏ|bé|trước)\s+", 0.86),
    Rule("isFamily", r"\btiền sử gia đình(?:\s+có)?\s+", 0.99),
    Rule("isFamily", r"\bgia đình(?:\s+bệnh nhân)?(?:\s+có|\s+ghi nhận)?\s+", 0.96),
    Rule("isFamily", r"\b(?:mẹ|má|bố|ba|cha|anh|chị|em|ông|bà|con)\s+(?:bị|mắc|có|từng bị|từng mắc)\s+", 0.94),
)
BOUNDARY = r"[.!?;\n]|\b(?:nhưng|tuy nhiên|song|dù vậy|mặc dù|trong khi)\b"
SCOPE, DECAY, LEAST_FACTOR, VERIFY_BELOW = 180, 240.0, 0.55, 0.82


def find_cues(text: str, rules=RULES, boundary: str = BOUNDARY) -> list[dict]:
    """Cues of all rules with their scopes, by place and then longest first.

    A scope is the SCOPE characters on the cue's side, up to the boundary in them that is nearest the cue.
    """
    stop = re.compile(boundary, re.I)
    out = []
    for label, pattern, conf, side in rules:
        for m in re.finditer(pattern, text, re.I):
            a, b = m.span()
            if side == "backward":
                near = text[max(0, a - SCOPE) : a]
                scope = (a - len(near) + max((x.end() for x in stop.finditer(near)), default=0), a)
            else:
                near = text[b : b + SCOPE]
                first = stop.search(near)
                scope = (b, b + (first.start() if first else len(near)))
            out.append({"label": label, "cue": m[0], "cue_start": a, "cue_end": b, "cue_confidence": conf, "direction": side, "scope_start": scope[0], "scope_end": scope[1]})
    return sorted(out, key=lambda c: (c["cue_start"], -c["cue_end"]))


CUES = "array<struct<label:string,cue:string,cue_start:int,cue_end:int,cue_confidence:double,direction:string,scope_start:int,scope_end:int>>"


def cues(docs: DataFrame, rules=RULES, boundary: str = BOUNDARY, key: str = "document_id", text: str = "raw_text") -> DataFrame:
    """(key, cue_ord, label, cue, ...): each document is scanned once."""

    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: find_cues(t or "", rules, boundary))

    return docs.select(key, F.posexplode(pandas_udf(scan, CUES)(text)).alias("cue_ord", "c")).select(key, "cue_ord", "c.*")


def apply_cues(found: DataFrame, entities: DataFrame, key: str = "document_id") -> DataFrame:
    """Evidence rows: cues whose scope contains the entity, with the confidence that distance leaves.

    An equi-join on the document with the containment as its residual condition.
    """
    joined = entities.select(key, "entity_index", "start", "end").join(found, key).where("scope_start <= start AND end <= scope_end")
    gap = F.greatest(F.lit(0), F.when(F.col("direction") == "backward", F.col("cue_start") - F.col("end")).otherwise(F.col("start") - F.col("cue_end")))
    return joined.withColumn("confidence", F.round(F.col("cue_confidence") * F.greatest(F.lit(LEAST_FACTOR), 1.0 - gap / DECAY), 4))


def _shown(evidence: DataFrame, key: str) -> DataFrame:
    """The evidence of each entity as an array, in the order of the cues."""
    return evidence.groupBy(key, "entity_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("cue_ord", "label", "cue", "cue_start", "cue_end", "scope_start", "scope_end", "confidence"))), lambda x: x.dropFields("cue_ord")).alias("evidence"))


def assertions(entities: DataFrame, evidence: DataFrame, key: str = "document_id", types: tuple[str, ...] = ASSERTION_TYPES, show: bool = True) -> DataFrame:
    """entities with assertions (sorted labels), assertion_confidence (least of the labels' greatest; 1 if none), needs_verification, and (show) evidence."""
    label = evidence.groupBy(key, "entity_index", "label").agg(F.max("confidence").alias("c"))
    per = label.groupBy(key, "entity_index").agg(F.sort_array(F.collect_set("label")).alias("_labels"), F.min("c").alias("_conf"))
    if show:
        per = per.join(_shown(evidence, key), [key, "entity_index"])
    ok = F.col("entity_type").isin(*types)
    out = entities.join(per, [key, "entity_index"], "left")
    labels = F.when(ok & F.col("_labels").isNotNull(), F.col("_labels")).otherwise(F.array().cast("array<string>"))
    conf = F.when(ok & F.col("_conf").isNotNull(), F.col("_conf")).otherwise(1.0)
    return out.withColumns({"assertions": labels, "assertion_confidence": conf, "needs_verification": (F.size(labels) > 0) & (conf < VERIFY_BELOW), "assertion_source": F.lit("rule_scope")}).drop("_labels", "_conf")


def detect(docs: DataFrame, entities: DataFrame, rules=RULES, boundary: str = BOUNDARY, key: str = "document_id", show: bool = True) -> DataFrame:
    """assertions() of entities(key, entity_index, entity_type, start, end) in docs(key, raw_text)."""
    usable = entities.where(F.col("entity_type").isin(*ASSERTION_TYPES))
    return assertions(entities, apply_cues(cues(docs, rules, boundary, key), usable, key), key, show=show)


def verify(rows: DataFrame, verifier, schema: str | None = None) -> DataFrame:
    """Rows that need it go through verifier(text, entity_text, labels, confidence) -> (labels, confidence); others stay.

    The filter stands before the Python stage, which Catalyst does not move.
    """
    doubtful, sure = rows.where("needs_verification"), rows.where("NOT needs_verification")

    def judge(batches):
        for pdf in batches:
            got = [verifier(t, e, list(a), c) for t, e, a, c in zip(pdf["raw_text"], pdf["text"], pdf["assertions"], pdf["assertion_confidence"], strict=True)]
            yield pdf.assign(assertions=[list(x) for x, _ in got], assertion_confidence=[float(c) for _, c in got], assertion_source="local_verifier", needs_verification=False)

    return sure.unionByName(doubtful.mapInPandas(judge, rows.schema))


def parse_verdict(output: str, labels: list[str], conf: float) -> tuple[list[str], float]:
    """Labels and confidence from the first {...} of a model's answer; unchanged without a JSON object."""
    said = first_object(output)
    if said is None:
        return labels, conf
    return [x for x in ASSERTIONS if said.get(x) is True], min(1.0, max(0.0, float(said.get("confidence", conf))))


# What a text model is asked.
VERDICT_PROMPT = "Bạn là bộ phân loại assertion y khoa. Trả JSON duy nhất."
VERDICT_SCHEMA = 'Schema: {"isNegated": bool, "isHistorical": bool, "isFamily": bool, "confidence": number}'


def generating_verifier(name: str, tokens_out: int = 80):
    """A verifier for verify() by a local text model of that name."""

    def judge(text: str, entity: str, labels: list[str], conf: float) -> tuple[list[str], float]:
        return parse_verdict(generate(name, f"{VERDICT_PROMPT}\nVăn bản: {text}\nThực thể: {entity}\n{VERDICT_SCHEMA}", tokens_out), labels, conf)

    return judge
