"""Queries of spans, assertions, validation and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assertion, metrics, ner, spans, validation
from ..schemas import ENTITY_TYPES
from ..tables import save
from ._base import HITS, LEXICON, lexicon_hits, notes, query

#: Cue rules and boundaries for the synthetic prose.
RULES = (assertion.Rule("isNegated", r"\bno\b", 0.97), assertion.Rule("isHistorical", r"\bwas\b", 0.9, "backward"), assertion.Rule("isFamily", r"\bthis\b", 0.94))


@query("p1_dedup_best", f"""
WITH {HITS}, twice AS (SELECT document_id, start, "end", entity_type, confidence, ord FROM hits UNION ALL SELECT document_id, start, "end", entity_type, confidence - 0.1 * (ord % 3), ord + 1000000 FROM hits)
SELECT document_id, start, "end", entity_type, max(confidence) AS confidence, min(ord)::BIGINT AS first_ord FROM twice GROUP BY ALL""")
def _(read):
    h = lexicon_hits(read).drop("text")
    twice = h.unionByName(h.withColumns({"confidence": F.col("confidence") - 0.1 * (F.col("ord") % 3), "ord": F.col("ord") + 1_000_000}))
    return spans.best_of_duplicates(twice).select("document_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "entity_type", "confidence", F.col("first_ord").cast("long").alias("first_ord"))


@query("p4_confidence_filter", f"WITH {HITS} SELECT document_id, start, confidence FROM hits WHERE confidence >= 0.5")
def _(read):
    return spans.keep_confident(lexicon_hits(read), 0.5).select("document_id", F.col("start").cast("long").alias("start"), "confidence")


# each hit is widened to the left by up to 12 characters, so that many overlap
_WIDE = f"""{HITS}, wide AS (SELECT document_id, entity_type, greatest(start - (ord * 7 % 13), 0) AS start, "end", confidence, ord, row_number() OVER (PARTITION BY document_id ORDER BY -confidence, greatest(start - (ord * 7 % 13), 0) - "end", ord) AS k FROM hits)"""


@query("p3_greedy_overlap", f"""
WITH RECURSIVE {_WIDE},
g AS (SELECT document_id, 0::BIGINT AS k, []::STRUCT(s BIGINT, e BIGINT)[] AS acc FROM (SELECT DISTINCT document_id FROM wide)
UNION ALL SELECT g.document_id, w.k, CASE WHEN len(list_filter(g.acc, lambda x: x.s < w."end" AND w.start < x.e)) > 0 THEN g.acc ELSE list_append(g.acc, {{'s': w.start::BIGINT, 'e': w."end"::BIGINT}}) END FROM g JOIN wide w ON w.document_id = g.document_id AND w.k = g.k + 1),
f AS (SELECT document_id, arg_max(acc, k) AS acc FROM g GROUP BY document_id)
SELECT document_id, x.s AS start, x.e AS "end" FROM (SELECT document_id, unnest(acc) AS x FROM f)""")
def _(read):
    wide = lexicon_hits(read).withColumn("start", F.greatest(F.col("start") - F.col("ord") * 7 % 13, F.lit(0))).withColumn("first_ord", F.col("ord"))
    return spans.resolve_overlaps(wide).select("document_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("p5_raw_offsets", f"""WITH {HITS} SELECT document_id, text, entity_type, start, "end" FROM hits WHERE confidence >= 0.5""")
def _(read):
    """Predictions in normalized text, whose raw text has two blanks more at its start, come back as raw offsets less two."""
    docs = notes(read).select("document_id", F.concat(F.lit("  "), "text").alias("raw_text"))
    texts = save(ner.normalize_documents(docs), "notes")
    found = ner.predict(texts.select("document_id", "text"), ner.Lexicon(LEXICON), list(ENTITY_TYPES), 0.5, 100_000, 0).drop("error")
    out = spans.postprocess(ner.ordered(found), texts, 0.5)
    return out.select("document_id", "text", "entity_type", (F.col("start") - 2).cast("long").alias("start"), (F.col("end") - 2).cast("long").alias("end"))


CUES = rf"""
{HITS}, cuerules(label, word, conf, direction) AS (VALUES ('isNegated', 'no', 0.97, 'f'), ('isHistorical', 'was', 0.9, 'b'), ('isFamily', 'this', 0.94, 'f')),
cue AS MATERIALIZED (SELECT p.doc_id::VARCHAR AS document_id, r.label, r.conf, r.direction, p."end" - length(p.word) AS cs, p."end" AS ce, d.text FROM placed p JOIN cuerules r ON lower(p.word) = r.word JOIN documents d ON d.doc_id = p.doc_id),
sc AS MATERIALIZED (SELECT document_id, label, conf, direction, cs, ce,
CASE direction WHEN 'f' THEN ce ELSE cs - length(regexp_extract(substring(text, greatest(cs - 180, 0)::INT + 1, (cs - greatest(cs - 180, 0))::INT), '[^.!?;\n]*$')) END AS ss,
CASE direction WHEN 'f' THEN ce + length(regexp_extract(substring(text, ce::INT + 1, 180), '^[^.!?;\n]*')) ELSE cs END AS se FROM cue),
ent AS (SELECT document_id, ord, entity_type, start, "end" FROM hits),
ev AS MATERIALIZED (SELECT e.document_id, e.ord, s.label, s.cs, round((s.conf::DOUBLE * greatest(0.55::DOUBLE, 1::DOUBLE - greatest(0, CASE s.direction WHEN 'b' THEN s.cs - e."end" ELSE e.start - s.ce END)::DOUBLE / 240::DOUBLE))::VARCHAR::DECIMAL(24, 20), 4)::DOUBLE AS confidence FROM ent e JOIN sc s ON s.document_id = e.document_id AND s.ss <= e.start AND e."end" <= s.se)"""


def _evidence(read):
    docs = notes(read).withColumnRenamed("text", "raw_text")
    entities = save(lexicon_hits(read).withColumnRenamed("ord", "entity_index"), "hits")
    return entities, assertion.apply_cues(assertion.cues(docs, RULES, r"[.!?;\n]"), entities)


@query("a2_cue_scan", f"WITH {CUES} SELECT document_id, label, cs::BIGINT AS cue_start, ce::BIGINT AS cue_end, ss::BIGINT AS scope_start, se::BIGINT AS scope_end FROM sc")
def _(read):
    found = assertion.cues(notes(read).withColumnRenamed("text", "raw_text"), RULES, r"[.!?;\n]")
    return found.select("document_id", "label", *[F.col(c).cast("long").alias(c) for c in ("cue_start", "cue_end", "scope_start", "scope_end")])


@query("a5_cue_scope_join", f"WITH {CUES} SELECT document_id, ord::BIGINT AS entity_index, label, cs::BIGINT AS cue_start, confidence FROM ev")
def _(read):
    return _evidence(read)[1].select("document_id", F.col("entity_index").cast("long").alias("entity_index"), "label", F.col("cue_start").cast("long").alias("cue_start"), "confidence")


@query("a6_assertion_rollup", f"""
WITH {CUES}, l AS (SELECT document_id, ord, label, max(confidence) AS c FROM ev GROUP BY ALL), r AS (SELECT document_id, ord, string_agg(label, ',' ORDER BY label) AS labels, min(c) AS c FROM l GROUP BY ALL)
SELECT e.document_id, e.ord::BIGINT AS entity_index, coalesce(r.labels, '') AS labels, coalesce(r.c, 1.0)::DOUBLE AS confidence, coalesce(r.c, 1.0) < 0.82 AND r.c IS NOT NULL AS needs_verification FROM ent e LEFT JOIN r USING (document_id, ord)""")
def _(read):
    entities, evidence = _evidence(read)
    return assertion.assertions(entities, evidence, show=False).select("document_id", F.col("entity_index").cast("long").alias("entity_index"), F.array_join("assertions", ",").alias("labels"), F.col("assertion_confidence").alias("confidence"), "needs_verification")


_ENT = f"""{HITS}, ents AS (SELECT document_id, (row_number() OVER (PARTITION BY document_id ORDER BY start) - 1)::BIGINT AS entity_index, CASE WHEN start % 17 = 0 THEN 'BAD' ELSE entity_type END AS entity_type, greatest(start - ord % 3, 0) AS start, "end" + CASE WHEN ord % 29 = 0 THEN 10000000 ELSE 0 END AS "end", text FROM hits)"""


def _entities(read):
    from pyspark.sql import Window as W

    h = lexicon_hits(read).withColumn("entity_index", F.row_number().over(W.partitionBy("document_id").orderBy("start")) - 1)
    return h.select("document_id", "entity_index", F.when(F.col("start") % 17 == 0, "BAD").otherwise(F.col("entity_type")).alias("entity_type"), F.greatest(F.col("start") - F.col("ord") % 3, F.lit(0)).alias("start"), (F.col("end") + F.when(F.col("ord") % 29 == 0, 10_000_000).otherwise(0)).alias("end"), "text")


@query("s9_entity_overlap_lag", f"""WITH {_ENT} SELECT document_id, entity_index, CASE WHEN count(*) OVER (PARTITION BY document_id, start, "end", entity_type) > 1 THEN 'duplicate_key'
WHEN start < lag("end") OVER (PARTITION BY document_id ORDER BY start, "end", entity_type, entity_index) THEN 'overlap' END AS set_error FROM ents""")
def _(read):
    return validation.entity_set_errors(_entities(read)).select("document_id", F.col("entity_index").cast("long").alias("entity_index"), "set_error")


@query("v4_overlap_violation", f"""WITH {_ENT} SELECT document_id, entity_index, coalesce(max("end") OVER (PARTITION BY document_id ORDER BY start, "end", entity_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > start, false) AS overlaps FROM ents""")
def _(read):
    return validation.overlap_with_earlier(_entities(read)).select("document_id", F.col("entity_index").cast("long").alias("entity_index"), "overlaps")


_TYPES = ", ".join(f"'{x}'" for x in ENTITY_TYPES)
_CHECK = f"""{_ENT}, chk AS (SELECT e.*, row_number() OVER (PARTITION BY e.document_id, start, "end", entity_type ORDER BY entity_index) > 1 AS again, NOT (start >= 0 AND start < "end" AND "end" <= length(d.text)) AS oob,
substring(d.text, start::INT + 1, least("end" - start, 1000)::INT) <> e.text AS differs FROM ents e JOIN documents d ON d.doc_id::VARCHAR = e.document_id),
msg AS (SELECT document_id, entity_index, list_filter([CASE WHEN again THEN 'duplicate' END, CASE WHEN entity_type NOT IN ({_TYPES}) THEN 'unknown_type' END, CASE WHEN oob THEN 'out_of_bounds' END, CASE WHEN NOT oob AND differs THEN 'text_mismatch' END], lambda x: x IS NOT NULL) AS errors,
CASE WHEN NOT oob AND entity_type NOT IN ('CHẨN_ĐOÁN', 'THUỐC') THEN ['candidates_dropped'] ELSE [] END AS warnings FROM chk)"""


def _checked(read):
    e = _entities(read).withColumns({"assertions": F.array(F.lit("isNegated")), "candidates": F.array(F.lit("c"))})
    return validation.output_errors(e, texts=notes(read).withColumnRenamed("text", "raw_text"))


@query("v1_output_validation", f"WITH {_CHECK} SELECT document_id, array_to_string(flatten(list(errors ORDER BY entity_index)), ',') AS errors, array_to_string(flatten(list(warnings ORDER BY entity_index)), ',') AS warnings, len(flatten(list(errors))) = 0 AS valid FROM msg GROUP BY document_id")
def _(read):
    v = validation.validate_documents(_checked(read))
    return v.select("document_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "valid")


@query("f14_entity_json", f"""WITH {HITS} SELECT document_id, start, '{{"text":"' || text || '","type":"' || entity_type || '","position":[' || start || ',' || "end" || ']' || ',"assertions":["isNegated"]' || CASE WHEN entity_type IN ('CHẨN_ĐOÁN', 'THUỐC') THEN ',"candidates":["c1"]' ELSE '' END || '}}' AS j FROM hits""")
def _(read):
    return lexicon_hits(read).withColumns({"assertions": F.array(F.lit("isNegated")), "candidates": F.array(F.lit("c1"))}).select("document_id", F.col("start").cast("long").alias("start"), validation.entity_json().alias("j"))


@query("v2_serialize", f"""WITH {HITS} SELECT document_id AS note_id, '{{"note_id":"' || document_id || '","entities":[' || string_agg('{{"text":"' || text || '","type":"' || entity_type || '","position":[' || start || ',' || "end" || '],"assertions":[]' || CASE WHEN entity_type IN ('CHẨN_ĐOÁN', 'THUỐC') THEN ',"candidates":[]' ELSE '' END || '}}', ',' ORDER BY start) || ']}}' AS output FROM hits GROUP BY document_id""")
def _(read):
    e = lexicon_hits(read).withColumnRenamed("ord", "entity_index").withColumns({"assertions": F.array().cast("array<string>"), "candidates": F.array().cast("array<string>")})
    return validation.serialize(e).select("note_id", "output")


_PRED = f"""{HITS}, gold AS (SELECT document_id, start, "end", entity_type FROM hits WHERE ord % 4 <> 0), pred AS (SELECT document_id, start + CASE WHEN ord % 5 = 0 THEN 1 ELSE 0 END AS start, "end" + CASE WHEN ord % 5 = 0 THEN 1 ELSE 0 END AS "end", entity_type FROM hits WHERE ord % 7 <> 0)"""
_PRF = "round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, 6) AS f1"


def _gold_pred(read):
    h = save(lexicon_hits(read), "hits")
    move = F.when(F.col("ord") % 5 == 0, 1).otherwise(0)
    return h.where("ord % 4 != 0"), h.where("ord % 7 != 0").withColumns({"start": F.col("start") + move, "end": F.col("end") + move})


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ("precision", "recall", "f1") else c for c in df.columns])


@query("e1_prf_exact", f"""WITH {_PRED}, c AS (SELECT (SELECT count(*) FROM gold SEMI JOIN pred USING (document_id, start, "end", entity_type)) AS tp, (SELECT count(*) FROM pred) AS p, (SELECT count(*) FROM gold) AS g),
n AS (SELECT tp, p - tp AS fp, g - tp AS fn FROM c) SELECT tp, fp, fn, {_PRF} FROM n""")
def _(read):
    return _rounded(metrics.exact_scores(*_gold_pred(read)))


@query("e3_prf_by_type", f"""WITH {_PRED}, m AS (SELECT coalesce(g.entity_type, p.entity_type) AS entity_type, (g.document_id IS NOT NULL AND p.document_id IS NOT NULL)::INT AS tp, (g.document_id IS NULL)::INT AS fp, (p.document_id IS NULL)::INT AS fn FROM gold g FULL JOIN pred p ON g.document_id = p.document_id AND g.start = p.start AND g."end" = p."end" AND g.entity_type = p.entity_type),
n AS (SELECT entity_type, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM m GROUP BY entity_type) SELECT entity_type, tp, fp, fn, {_PRF} FROM n""")
def _(read):
    return _rounded(metrics.exact_scores(*_gold_pred(read), by=("entity_type",)))


@query("e3_prf_overlap", f"""WITH {_PRED}, a AS (SELECT entity_type, count(*) AS g FROM gold GROUP BY 1), b AS (SELECT entity_type, count(*) AS p FROM pred GROUP BY 1),
t AS (SELECT g.entity_type, count(*) AS tp FROM gold g JOIN pred p ON g.document_id = p.document_id AND g.entity_type = p.entity_type AND p.start < g."end" AND g.start < p."end" GROUP BY 1),
n AS (SELECT entity_type, coalesce(tp, 0)::BIGINT AS tp, (p - coalesce(tp, 0))::BIGINT AS fp, (g - coalesce(tp, 0))::BIGINT AS fn FROM a JOIN b USING (entity_type) LEFT JOIN t USING (entity_type)) SELECT entity_type, tp, fp, fn, {_PRF} FROM n""")
def _(read):
    """Words stand at least two characters apart, so each overlaps one of the other side at most."""
    return _rounded(metrics.overlap_scores(*_gold_pred(read)))


@query("e6_run_summary", "SELECT count(*) AS total, count(*) FILTER (doc_id % 9 <> 0) AS succeeded, count(*) FILTER (doc_id % 9 = 0) AS failed FROM documents")
def _(read):
    return metrics.run_summary(read("documents").select(F.when(F.col("doc_id") % 9 == 0, "x").alias("error")))


@query("c3_model_predict", f"""WITH {HITS} SELECT document_id, start, "end", text, entity_type, confidence FROM hits WHERE confidence >= 0.5""")
def _(read):
    """Chunks overlap, so duplicates of the overlap go."""
    found = ner.predict(notes(read), ner.Lexicon(LEXICON), list(ENTITY_TYPES)).drop("error")
    return found.select("document_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "text", "entity_type", "confidence").distinct()


@query("d2_drug_rules", """SELECT doc_id::VARCHAR AS document_id, 'Undol' AS text, 0::BIGINT AS start, 5::BIGINT AS "end" FROM documents WHERE doc_id % 2 = 0""")
def _(read):
    """Every note begins with a drug; every second one gives its dose, which makes it a prediction."""
    line = F.when(F.col("doc_id") % 2 == 0, "Undol 5 mg\n").otherwise("Undol\n")
    docs = read("documents").select(F.col("doc_id").cast("string").alias("document_id"), F.concat(line, "text").alias("text"))
    return ner.drug_predictions(docs, ["undol"]).select("document_id", "text", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
