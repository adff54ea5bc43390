"""Queries of whole stages and of the parts that the other modules leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import assertion, export, linking, markers, metrics, ner, synth
from ..plans.pipeline import Pipeline
from ..schemas import DIAGNOSIS, DRUG, ENTITY_TYPES
from ._base import HITS, LEXICON, lexicon_hits, lexicon_words, notes, query
from .entities import CUES, RULES
from .links import BM25, DECIDE, MENTIONS, NAMES, TOKENS, decided, mentions
from .texts import CHAIN, NOISE_SQL, noisy

# ---- text ---------------------------------------------------------------------------------------


@query("n3c_newline_to_space", r"""
WITH a AS (SELECT doc_id, regexp_replace({noise}, '\r\n?', chr(10), 'g') AS x FROM documents),
b AS (SELECT doc_id, regexp_replace(x, '[\x00-\x08\x0b-\x1f\x7f-\x9f\p{{Cf}}]', '', 'g') AS x FROM a),
c AS (SELECT doc_id, replace(replace(translate(x, '“”‘’–—×', '""''''--x'), '…', '...'), chr(10), ' ') AS x FROM b),
d AS (SELECT doc_id, regexp_replace(x, '[ \t]+', ' ', 'g') AS x FROM c),
e AS (SELECT doc_id, regexp_replace(regexp_replace(x, ' +([,.;:!?)\]}}])', '\1', 'g'), '([(\[{{]) +', '\1', 'g') AS x FROM d)
SELECT doc_id, regexp_replace(x, '^\s+|\s+$', '', 'g') AS text FROM e""".format(noise=NOISE_SQL))
def _(read):
    return read("documents").select("doc_id", t.normalize(noisy(), keep_lines=False).alias("text"))


@query("n11_map_validator", "SELECT p_partkey, p_partkey % 5 IN (0, 4) AS valid FROM part")
def _(read):
    """A sound map, one that is too short, one that goes back, one out of range, and one that repeats a place."""
    k = F.col("p_partkey") % 5
    a = lambda *x: F.array(*map(F.lit, x))
    at = F.when(k == 0, a(0, 1, 2)).when(k == 1, a(0, 1)).when(k == 2, a(0, 2, 1)).when(k == 3, a(0, 1, 9)).otherwise(a(0, 0, 2))
    return read("part").select("p_partkey", t.valid_map(F.lit("abc"), at, F.lit(3)).alias("valid"))


@query("n14_document_normalize", CHAIN + rf"SELECT f.doc_id::VARCHAR AS document_id, length({NOISE_SQL})::BIGINT AS raw_length, length(regexp_replace(x, '^\s+|\s+$', '', 'g'))::BIGINT AS normalized_length, true AS collapse_spaces FROM f JOIN documents USING (doc_id)")
def _(read):
    m = ner.normalize_documents(read("documents").select(F.col("doc_id").cast("string").alias("document_id"), noisy().alias("raw_text"))).select("document_id", "metadata.*")
    return m.select("document_id", F.col("raw_length").cast("long").alias("raw_length"), F.col("normalized_length").cast("long").alias("normalized_length"), "collapse_spaces")


@query("f3_strip_diacritics", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def _(read):
    return read("documents").select("doc_id", t.strip_diacritics("text").alias("text"))


@query("f8_cue_presence", r"SELECT doc_id, regexp_matches(' ' || lower(text) || ' ', '[^\p{L}\p{N}_](?:no|was|of the)[^\p{L}\p{N}_]') AS cue FROM documents")
def _(read):
    return read("documents").select("doc_id", markers.has_cue(F.col("text"), ("no", "was", "of the")).alias("cue"))


@query("f9_scope_prefix", r"SELECT doc_id, regexp_replace(regexp_extract(lower(substring(text, 1, (length(text) // 2)::INT)), '[^\n.;:]*$'), '^(?s).*(?:and|der)', '') AS prefix FROM documents")
def _(read):
    d = read("documents").withColumn("s", F.floor(F.length("text") / 2).cast("int"))
    return d.select("doc_id", t.scope_prefix("text", "s", ("and", "der")).alias("prefix"))


@query("f10_local_window", "WITH s AS (SELECT doc_id, text, (length(text) // 2)::INT AS s FROM documents) SELECT doc_id, lower(substring(text, greatest(s - 180, 0) + 1, s + 103 - greatest(s - 180, 0))) AS w FROM s")
def _(read):
    d = read("documents").withColumn("s", F.floor(F.length("text") / 2).cast("int"))
    return d.select("doc_id", t.local_window("text", "s", F.col("s") + 3).alias("w"))


# ---- assertions ---------------------------------------------------------------------------------

_TOLD = """told AS (SELECT p_partkey, length(p_name)::BIGINT AS n, p_partkey % 5 AS k FROM part)"""


@query("a1_cue_rules", f"""WITH {_TOLD}
SELECT p_partkey::VARCHAR AS document_id, CASE WHEN k IN (0, 4) THEN 'isNegated' WHEN k = 3 THEN 'isFamily' ELSE 'isHistorical' END AS label, CASE k WHEN 0 THEN 10 WHEN 2 THEN n + 1 ELSE 0 END::BIGINT AS cue_start, CASE k WHEN 0 THEN 19 WHEN 1 THEN 11 WHEN 2 THEN n + 15 WHEN 3 THEN 6 ELSE 9 END::BIGINT AS cue_end,
CASE k WHEN 0 THEN 19 WHEN 1 THEN 11 WHEN 2 THEN 0 WHEN 3 THEN 6 ELSE 9 END::BIGINT AS scope_start, CASE k WHEN 0 THEN 19 + n WHEN 1 THEN 11 + n WHEN 2 THEN n + 1 WHEN 3 THEN 7 + n ELSE 9 + n END::BIGINT AS scope_end FROM told""")
def _(read):
    """The rules themselves, on a sentence of each kind around a part's name."""
    k, n = F.col("p_partkey") % 5, F.col("p_name")
    said = F.when(k == 0, F.concat(F.lit("Bệnh nhân không có "), n, F.lit(". Ổn."))).when(k == 1, F.concat(F.lit("Tiền sử bị "), n, F.lit("; ổn."))).when(k == 2, F.concat(n, F.lit(" cách đây 3 năm"))).when(k == 3, F.concat(F.lit("Mẹ bị "), n, F.lit(" nhưng khỏe"))).otherwise(F.concat(F.lit("Phủ nhận "), n))
    found = assertion.cues(read("part").select(F.col("p_partkey").cast("string").alias("document_id"), said.alias("raw_text")))
    return found.select("document_id", "label", *[F.col(c).cast("long").alias(c) for c in ("cue_start", "cue_end", "scope_start", "scope_end")])


def _verdict(text, entity, labels, conf):
    return assertion.parse_verdict(f'so: {{"isFamily": true, "isNegated": {"true" if "isNegated" in labels else "false"}, "confidence": 1.5}} end', labels, conf)


@query("a8_verifier", "SELECT p_partkey, CASE WHEN p_size < 25 THEN 'isNegated,isFamily' ELSE 'isNegated' END AS labels, CASE WHEN p_size < 25 THEN 1.0 ELSE p_size / 50.0 END::DOUBLE AS confidence, CASE WHEN p_size < 25 THEN 'local_verifier' ELSE 'rule_scope' END AS source FROM part")
def _(read):
    """Doubtful rows go through a verifier whose answer is parsed from text; the others do not."""
    p = read("part").select("p_partkey", F.col("p_type").alias("raw_text"), F.col("p_name").alias("text"), F.array(F.lit("isNegated")).alias("assertions"), (F.col("p_size") / 50.0).alias("assertion_confidence"), F.lit("rule_scope").alias("assertion_source"), (F.col("p_size") < 25).alias("needs_verification"))
    return assertion.verify(p, _verdict).select("p_partkey", F.array_join("assertions", ",").alias("labels"), F.col("assertion_confidence").alias("confidence"), F.col("assertion_source").alias("source"))


# ---- linking ------------------------------------------------------------------------------------

_UNIQUE = """names AS (SELECT min(p_partkey)::VARCHAR AS code, p_name AS name, min(p_type) AS description FROM part GROUP BY p_name)"""


def unique_names(read):
    """An ontology in which every name is one code."""
    return read("part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").cast("string").alias("code"), F.min("p_type").alias("description")).select("code", "name", F.array().cast("array<string>").alias("aliases"), "description", F.lit("ICD10").alias("ontology"))


@query("l9_link_exact_branch", rf"""
WITH {MENTIONS}, {_UNIQUE}, k AS (SELECT code, array_to_string({TOKENS.format('name')}, ' ') AS k FROM names), u AS (SELECT k, count(*) AS n, min(code) AS code FROM k GROUP BY k)
SELECT m.query_id, u.code AS selected_code, 1.0::DOUBLE AS confidence, u.code AS candidates FROM men m JOIN u ON array_to_string({TOKENS.format('m.mention')}, ' ') = u.k WHERE n = 1""")
def _(read):
    out = linking.link(mentions(read).withColumn("context", F.lit("")), unique_names(read), "ICD10")
    return out.where("method = 'exact_alias'").select("query_id", "selected_code", "confidence", F.array_join("candidates", ",").alias("candidates"))


def _by_rank(candidates, key="query_id"):
    return linking.ranked(candidates.withColumn("final_score", 1.0 / F.col("rank")).withColumnRenamed("rank", "_before"), key, [F.desc("final_score")], 5).drop("_before")


@query("l6_hybrid_link", rf"""
WITH {BM25.replace(NAMES, _UNIQUE)}, k AS (SELECT DISTINCT array_to_string({TOKENS.format('name')}, ' ') AS k FROM names), rest AS (SELECT query_id FROM men WHERE array_to_string({TOKENS.format('mention')}, ' ') NOT IN (SELECT k FROM k)),
h AS (SELECT query_id, code, rank, 0 AS s FROM bm SEMI JOIN rest USING (query_id) UNION ALL SELECT query_id, code, rank, 1 FROM rest, (SELECT code, row_number() OVER (ORDER BY code) AS rank FROM names QUALIFY rank <= 3)),
f AS (SELECT query_id, code, sum(1.0::DOUBLE / (60 + rank)) AS fused, min(s * 1000 + rank) AS first FROM h GROUP BY ALL),
r AS (SELECT query_id, code, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 12) DESC, first, code) AS rank FROM f QUALIFY rank <= 5)
SELECT query_id, string_agg(code, ',' ORDER BY rank) AS candidates, max(code) FILTER (rank = 1) AS selected_code FROM r GROUP BY query_id""")
def _(read):
    """Mentions without an exact name: BM25 fused with a second retriever, here the three first codes for each query."""
    names = unique_names(read)
    few = F.broadcast(linking.ranked(names.select(F.lit(1).alias("g"), "code"), "g", ["code"], 3).select("code", "rank", (1.0 / F.col("rank")).alias("score")))
    out = linking.link(mentions(read).withColumn("context", F.lit("")), names, "ICD10", reranker=_by_rank, retrievers=(lambda q, key: q.select(key).join(few, F.lit(True)),))
    return out.where("method = 'hybrid_reranker'").select("query_id", F.array_join("candidates", ",").alias("candidates"), "selected_code")


@query("l11_disambiguate", DECIDE + ", l AS (SELECT query_id, arg_max(code, rank) AS last FROM r GROUP BY 1) SELECT query_id, CASE WHEN n > 1 AND abs(p.c1 - c2) < 0.04 AND query_id % 2 = 0 THEN last ELSE selected_code END AS selected_code, CASE WHEN n > 1 AND abs(p.c1 - c2) < 0.04 AND query_id % 2 = 0 THEN 'local_disambiguator' ELSE method END AS method, needs_review AND NOT (n > 1 AND abs(p.c1 - c2) < 0.04 AND query_id % 2 = 0) AS needs_review FROM dec JOIN p USING (query_id) JOIN l USING (query_id)")
def _(read):
    """A chooser that takes the last candidate of even queries, and answers with an unknown code to the others."""
    d = decided(read)
    out = linking.disambiguate(d, lambda q, codes: codes[-1] if int(q) % 2 == 0 else "?", d.select("query_id", F.col("query_id").cast("string").alias("query")))
    return out.select("query_id", "selected_code", "method", "needs_review")


# ---- training, cases ----------------------------------------------------------------------------


@query("x7_char_spans", "SELECT p_partkey, [{'start': 0, 'end': p_size::INTEGER, 'label': p_brand}, {'start': 3, 'end': 4, 'label': p_type}]::STRUCT(start INTEGER, \"end\" INTEGER, label VARCHAR)[]::VARCHAR AS spans FROM part")
def _(read):
    e = lambda s, end, kind: F.struct(F.array(F.lit(s), end.cast("int")).alias("position"), F.col(kind).alias("type"))
    spans = read("part").withColumn("entities", F.array(e(0, F.col("p_size"), "p_brand"), e(3, F.lit(4), "p_type"))).select("p_partkey", export.char_spans().alias("s"))
    told = lambda x: F.concat(F.lit("{'start': "), x["start"].cast("string"), F.lit(", 'end': "), x["end"].cast("string"), F.lit(", 'label': "), x["label"], F.lit("}"))
    return spans.select("p_partkey", F.concat(F.lit("["), F.array_join(F.transform("s", told), ", "), F.lit("]")).alias("spans"))


def _specs(read):
    """A case for each part: two sections of a block each."""
    entity = lambda i, text: F.struct(F.lit(f"E{i}").alias("entity_id"), F.col(text).alias("surface_text"), F.lit("TRIỆU_CHỨNG").alias("entity_type"), F.array().cast("array<string>").alias("assertions"), F.array().cast("array<string>").alias("candidates"))
    negative = F.struct(F.lit("N0").alias("negative_id"), F.col("p_type").alias("surface_text"))
    none = F.array().cast("array<struct<negative_id:string,surface_text:string>>")
    section = lambda i, text, negatives: F.struct(F.lit(f"S{i}").alias("section_id"), F.lit("x").alias("section_type"), F.lit(f"T{i}").alias("title"), F.lit("current").alias("temporal_scope"), F.lit("patient").alias("subject_scope"), F.array(F.struct(F.lit(f"B{i}").alias("block_id"), F.lit("patient_current_positive").alias("scenario_id"), F.array(entity(i, text)).alias("entities"), negatives.alias("hard_negatives"))).alias("blocks"))
    return read("part").select(F.col("p_partkey").cast("string").alias("case_id"), F.lit("p").alias("profile"), F.lit("none").alias("noise"), F.array(section(0, "p_name", none), section(1, "p_brand", F.array(negative))).alias("sections"))


@query("q11_marker_map", "SELECT p_partkey::VARCHAR AS case_id, m.k AS marker_id, m.v AS surface_text FROM (SELECT p_partkey, unnest([{'k': 'E0', 'v': p_name}, {'k': 'E1', 'v': p_brand}, {'k': 'N0', 'v': p_type}]) AS m FROM part)")
def _(read):
    return synth.expected_markers(_specs(read))


@query("q8_section_check", """
SELECT p_partkey::VARCHAR AS case_id, 'S1' AS marker_id, 'missing_section' AS error FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey::VARCHAR, 'S7', 'unknown_section' FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey::VARCHAR, 'S0/E0', 'missing' FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey::VARCHAR, 'S0', 'surface_count ' || p_name || ' 0 1' FROM part WHERE p_partkey % 2 = 0""")
def _(read):
    """Rendered sections: the second missing, a foreign one, the first without its marker."""
    k = F.col("p_partkey")
    mark = lambda i, c: F.concat(F.lit(f"[[{i}]]"), F.col(c), F.lit(f"[[/{i}]]"))
    section = lambda name, text: F.struct(F.lit(name).alias("section_id"), text.alias("marked"))
    parts = F.array(section("S0", F.when(k % 2 == 0, "x").otherwise(mark("E0", "p_name"))), F.when(k % 3 != 0, section("S1", F.concat_ws(" ", mark("E1", "p_brand"), mark("N0", "p_type")))), F.when(k % 5 == 0, section("S7", F.lit("y"))))
    rendered = read("part").select(k.cast("string").alias("case_id"), F.filter(parts, lambda x: x.isNotNull()).alias("sections"))
    return synth.section_errors(_specs(read), rendered)


@query("x5_aligned_entities", """
SELECT p_partkey::VARCHAR AS case_id, 0::INTEGER AS entity_index, p_name AS text, 2::INTEGER AS start, (2 + length(p_name))::INTEGER AS "end" FROM part
UNION ALL SELECT p_partkey::VARCHAR, 1, p_brand, (5 + length(p_name) + length(p_type))::INTEGER, (5 + length(p_name) + length(p_type) + length(p_brand))::INTEGER FROM part""")
def _(read):
    """Entities of marked notes in the stripped text, without the specs' ids and without the negatives."""
    mark = lambda i, c: F.concat(F.lit(f"[[{i}]]"), F.col(c), F.lit(f"[[/{i}]]"))
    marked = read("part").select(F.col("p_partkey").cast("string").alias("case_id"), F.concat(F.lit("x "), mark("E0", "p_name"), F.lit(" "), mark("N0", "p_type"), F.lit(": "), mark("E1", "p_brand")).alias("marked_text"))
    return synth.aligned_entities(_specs(read), marked).select("case_id", F.col("entity_index").cast("int").alias("entity_index"), "text", "start", "end")


@query("m3_build_samples", f"""WITH {HITS}, h AS (SELECT document_id, count(*) AS n FROM hits GROUP BY 1) SELECT d.doc_id::VARCHAR AS document_id, CASE WHEN h.n IS NULL THEN 'no_training_chunks' WHEN doc_id % 4 = 0 THEN 'raw_text_mismatch' WHEN doc_id % 4 = 1 THEN 'invalid_entity_label' WHEN doc_id % 4 = 2 THEN 'raw_span_out_of_bounds' ELSE 'duplicate_entity' END AS code, CASE WHEN doc_id % 4 < 3 AND h.n IS NOT NULL THEN 0 ELSE -1 END::INTEGER AS entity_index FROM documents d LEFT JOIN h ON h.document_id = d.doc_id::VARCHAR""")
def _(read):
    """A build in which every document has a fault of its own kind, and is skipped and logged."""
    k = F.col("document_id").cast("long") % 4
    e = F.struct(F.when(k == 0, "?").otherwise(F.col("e.text")).alias("text"), F.col("e.start").alias("start"), F.when(k == 2, F.lit(100_000_000)).otherwise(F.col("e.end")).alias("end"), F.when(k == 1, " ").otherwise(F.col("e.entity_type")).alias("entity_type"))
    own = F.when(F.col("e").isNull(), F.array().cast("array<struct<text:string,start:int,end:int,entity_type:string>>")).when(k == 3, F.array(e, e)).otherwise(F.array(e))
    docs = notes(read).withColumn("e", F.get(lexicon_words("text"), F.lit(0))).select("document_id", F.col("text").alias("raw_text"), own.alias("entities"))
    return export.build_samples(docs)[1].withColumn("entity_index", F.coalesce("entity_index", F.lit(-1)))


# ---- whole runs ---------------------------------------------------------------------------------


@query("c7_unavailable_model", """SELECT doc_id::VARCHAR AS note_id, '{"note_id":"' || doc_id || '","entities":[]}' AS output, 'RuntimeError: the model is not available' AS error FROM documents""")
def _(read):
    """Every note fails for itself and still has an output.  (A blank text has no chunk to fail on; there is none here.)"""
    return Pipeline(ner.Unavailable()).run(notes(read).withColumnRenamed("text", "raw_text"))


@query("e5_baseline", f"""WITH {HITS}, n AS (SELECT count(*) AS g, count(*) FILTER (confidence >= 0.5) AS tp FROM hits) SELECT tp, 0::BIGINT AS fp, g - tp AS fn, round(tp / g::DOUBLE, 6) AS recall FROM n""")
def _(read):
    """The lexicon model against all lexicon words as gold: it leaves out the weak ones."""
    found, _ = Pipeline(ner.Lexicon(LEXICON)).entities(notes(read).withColumnRenamed("text", "raw_text"))
    m = metrics.exact_scores(lexicon_hits(read), found)
    return m.select("tp", "fp", "fn", F.round("recall", 6).alias("recall"))


def codes(read):
    """Ontologies of the lexicon's words; `undol` is a drug of the rules alone."""
    spark = read("region").sparkSession
    rows = lambda words: spark.createDataFrame([(c, n, [], "") for c, n in words], "code string, name string, aliases array<string>, description string")
    return {DIAGNOSIS: ("ICD10", rows([("J18", "und"), ("I10", "of")])), DRUG: ("RXNORM", rows([("11", "der"), ("12", "and"), ("13", "Undol")]))}


@query("pipeline_notes", f"""
WITH {CUES}, lab AS (SELECT document_id, ord, list_sort(list(DISTINCT label)) AS a FROM ev GROUP BY ALL), code(w, c) AS (VALUES ('und', 'J18'), ('of', 'I10'), ('der', '11'), ('and', '12')),
e AS (SELECT h.document_id, h.start + o.shift AS start, '{{"text":"' || h.text || '","type":"' || h.entity_type || '","position":[' || (h.start + o.shift) || ',' || (h."end" + o.shift) || '],"assertions":[' || coalesce('"' || array_to_string(lab.a, '","') || '"', '') || ']' || coalesce(',"candidates":["' || code.c || '"]', '') || '}}' AS j
FROM hits h JOIN (SELECT doc_id::VARCHAR AS document_id, CASE WHEN doc_id % 2 = 0 THEN 11 ELSE 0 END AS shift FROM documents) o USING (document_id) LEFT JOIN lab ON lab.document_id = h.document_id AND lab.ord = h.ord LEFT JOIN code ON code.w = lower(h.text) WHERE h.confidence >= 0.5
UNION ALL SELECT doc_id::VARCHAR, 0, '{{"text":"Undol","type":"THUỐC","position":[0,5],"assertions":[],"candidates":["13"]}}' FROM documents WHERE doc_id % 2 = 0)
SELECT d.doc_id::VARCHAR AS note_id, '{{"note_id":"' || d.doc_id || '","entities":[' || coalesce(string_agg(e.j, ',' ORDER BY e.start), '') || ']}}' AS output, NULL::VARCHAR AS error FROM documents d LEFT JOIN e ON e.document_id = d.doc_id::VARCHAR GROUP BY d.doc_id""")
def _(read):
    """Model, drug rules, assertions, ontologies, validation and JSON over whole documents; every second one begins with a dosed drug."""
    head = F.when(F.col("document_id").cast("long") % 2 == 0, "Undol 5 mg\n").otherwise("")
    docs = notes(read).select("document_id", F.concat(head, "text").alias("raw_text"))
    return Pipeline(ner.Lexicon(LEXICON), ontologies=codes(read), drug_names=["Undol"], rules=RULES, boundary=r"[.!?;\n]", labels=list(ENTITY_TYPES)).run(docs)
