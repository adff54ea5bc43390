"""Queries of catalogs, marked notes, exports and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, export, markers, synth, validation
from ..tables import spread
from ._base import HITS, lexicon_hits, lexicon_words, notes, query


@query("s17_last_wins_dedup", "SELECT p_brand, p_size, arg_max(p_name, p_partkey) AS name, min(p_partkey) AS position FROM part GROUP BY ALL")
def _(read):
    return catalog.last_wins(read("part"), ["p_brand", "p_size"], "p_partkey").select("p_brand", "p_size", F.col("p_name").alias("name"), "position")


@query("t1_label_counts", f"WITH {HITS} SELECT entity_type AS label, count(*) AS n FROM hits GROUP BY 1")
def _(read):
    s = lexicon_hits(read).groupBy("document_id").agg(F.collect_list(F.struct("start", "end", F.col("entity_type").alias("label"))).alias("ner"))
    return export.label_counts(s)


@query("t1_mention_explode", f"""WITH {HITS} SELECT document_id AS id, row_number() OVER (PARTITION BY document_id ORDER BY ord) - 1 AS idx, text AS surface, CASE WHEN entity_type = 'THUỐC' THEN 'CHẨN_ĐOÁN' ELSE 'TRIỆU_CHỨNG' END AS entity_type FROM hits""")
def _(read):
    label = F.transform("hits", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["entity_type"] == "THUỐC", "DISEASE").otherwise("SYMPTOM").alias("type")))
    rows = notes(read).select(F.col("document_id").alias("id"), "text", lexicon_words("text").alias("hits")).select("id", "text", label.alias("label"))
    return catalog.mentions(rows).select("id", F.col("index").cast("long").alias("idx"), "surface", "entity_type")


_SURF = """raw AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' ab ,' WHEN 1 THEN 'no ' || p_name WHEN 2 THEN p_name || ' steel' WHEN 3 THEN 'N/A' WHEN 4 THEN p_name || ' ;,' ELSE 'reject me' END AS raw, CASE p_partkey % 2 WHEN 0 THEN 'S' ELSE 'D' END AS kind FROM part)"""


@query("t2_surface_reject", rf"""
WITH {_SURF}, c AS (SELECT p_partkey, kind, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS t FROM raw), b AS (SELECT *, regexp_replace(t, '[ ,;:]+$', '') AS f, lower(trim(regexp_replace(t, '[ ,;:]+$', ''), ' .,;:!?()[]{{}}"''')) AS k FROM c),
r AS (SELECT *, CASE WHEN lower(t) = 'n/a' THEN 'empty' WHEN length(f) < 3 THEN 'too_short' WHEN k = 'reject me' THEN 'manual_reject' WHEN kind = 'S' AND regexp_matches(f, '(?i)(^|[^\p{{L}}\p{{N}}_])no([^\p{{L}}\p{{N}}_]|$)') THEN 'embedded_assertion_cue'
WHEN kind = 'S' AND starts_with(k, 'red ') THEN 'contextual_prefix' WHEN kind = 'S' AND k LIKE '%steel' AND len(string_split(k, ' ')) <= 4 THEN 'incomplete_directional_fragment' END AS reason FROM b)
SELECT p_partkey, CASE WHEN reason IS NULL THEN f END AS surface, reason FROM r""")
def _(read):
    k = F.col("p_partkey") % 6
    raw = F.when(k == 0, " ab ,").when(k == 1, F.concat(F.lit("no "), "p_name")).when(k == 2, F.concat("p_name", F.lit(" steel"))).when(k == 3, "N/A").when(k == 4, F.concat("p_name", F.lit(" ;,"))).otherwise("reject me")
    rows = read("part").select("p_partkey", raw.alias("raw"), F.when(F.col("p_partkey") % 2 == 0, "S").otherwise("D").alias("kind"))
    surface, reason = catalog.surface_verdict("raw", "kind", corrections={}, rejected=("reject me",), prefixes=("red ",), cue_words=("no",), directions=("steel",), symptom="S")
    return rows.select("p_partkey", surface.alias("surface"), reason.alias("reason"))


_CONCEPT = r"""con AS (SELECT p_partkey::VARCHAR AS concept_id, ['IN', 'SCDC', 'SCD', 'SBD', 'BN', 'DF'][(p_partkey % 6 + 1)::INT] AS tty, p_name || CASE WHEN p_partkey % 6 IN (1, 2, 3) THEN ' ' || p_size || CASE p_partkey % 5 WHEN 0 THEN ',5' ELSE '' END || ' MG' ELSE '' END
|| CASE WHEN p_partkey % 6 IN (2, 3) THEN CASE p_partkey % 4 WHEN 0 THEN ' Oral Tablet' WHEN 1 THEN ' Topical Cream' WHEN 2 THEN ' / water 2 ML' ELSE '' END ELSE '' END || CASE WHEN p_partkey % 6 IN (3, 4) THEN ' [' || p_brand || ']' ELSE '' END AS name FROM part),
par AS (SELECT *, trim(regexp_replace(name, '\[([^\[\]]+)\]\s*$', '')) AS bare, nullif(regexp_extract(name, '\[([^\[\]]+)\]\s*$', 1), '') AS brand FROM con),
str AS (SELECT *, regexp_extract_all(bare, '(?i)\d+(?:[.,]\d+)?\s*(?:mcg/ml|mg/ml|g/ml|mg|mcg|µg|g|ml|%)') AS found FROM par),
cpt AS (SELECT concept_id, tty, name, CASE WHEN len(found) > 0 THEN trim(regexp_replace(bare, '(?is)\d+(?:[.,]\d+)?\s*(?:mcg/ml|mg/ml|g/ml|mg|mcg|µg|g|ml|%).*$', ''), ' ,;/:-') ELSE bare END AS ingredient_text,
CASE WHEN len(found) > 0 THEN replace(regexp_extract(found[1], '^[0-9.,]+'), ',', '.') END AS strength_value, CASE WHEN len(found) > 0 THEN lower(regexp_extract(found[1], '[^0-9.,\s]+$')) END AS strength_unit,
CASE WHEN bare ILIKE '%oral tablet%' THEN 'oral_tablet' WHEN bare ILIKE '%topical cream%' THEN 'topical_cream' END AS dose_form, brand, len(found) > 1 OR contains(bare, ' / ') AS complex_product FROM str)"""


def concepts(read):
    k = F.col("p_partkey") % 6
    strength = F.when(k.isin(1, 2, 3), F.concat(F.lit(" "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 5 == 0, ",5").otherwise(""), F.lit(" MG"))).otherwise("")
    f = F.col("p_partkey") % 4
    form = F.when(k.isin(2, 3), F.when(f == 0, " Oral Tablet").when(f == 1, " Topical Cream").when(f == 2, " / water 2 ML").otherwise("")).otherwise("")
    name = F.concat("p_name", strength, form, F.when(k.isin(3, 4), F.concat(F.lit(" ["), "p_brand", F.lit("]"))).otherwise(""))
    rows = spread(read("part")).select(F.col("p_partkey").cast("string").alias("concept_id"), F.get(F.array(*map(F.lit, ("IN", "SCDC", "SCD", "SBD", "BN", "DF"))), k.cast("int")).alias("tty"), name.alias("name"))
    return rows.withColumns(catalog.parse_concept())


@query("t3_strength_parse", f"WITH {_CONCEPT} SELECT concept_id, ingredient_text, strength_value, strength_unit, dose_form, brand, complex_product FROM cpt")
def _(read):
    return concepts(read).select("concept_id", "ingredient_text", "strength_value", "strength_unit", "dose_form", "brand", "complex_product")


_SURFACES = f"""{_CONCEPT}, sv AS (SELECT *, CASE WHEN strength_value IS NOT NULL THEN unnest([strength_value || ' ' || strength_unit, strength_value || strength_unit]) END AS s FROM cpt WHERE strength_value IS NOT NULL AND NOT complex_product AND tty IN ('SCDC', 'SCD', 'SBD')),
fs(dose_form, x) AS (VALUES ('oral_tablet', 'viên'), ('oral_tablet', 'viên nén'), ('oral_tablet', 'tablet'), ('oral_tablet', 'tab'), ('topical_cream', 'kem bôi'), ('topical_cream', 'cream')),
ro(dose_form, x) AS (VALUES ('oral_tablet', 'po'), ('oral_tablet', 'uống'), ('topical_cream', 'bôi ngoài da')), fr(x) AS (VALUES ('daily'), ('qd'), ('ngày 1 lần'), ('mỗi ngày'), ('mỗi sáng')),
surf AS (SELECT concept_id, ingredient_text AS text, 'ingredient_only' AS profile FROM cpt WHERE tty = 'IN' UNION ALL SELECT concept_id, coalesce(brand, name), 'brand_only' FROM cpt WHERE tty = 'BN'
UNION ALL SELECT concept_id, lower(name), 'canonical' FROM cpt WHERE tty IN ('SCDC', 'SCD', 'SBD') UNION ALL SELECT concept_id, ingredient_text || ' ' || s, 'ingredient_strength' FROM sv
UNION ALL SELECT concept_id, ingredient_text || ' ' || s || ' ' || fs.x, 'ingredient_strength_form' FROM sv JOIN fs USING (dose_form) WHERE tty <> 'SCDC'
UNION ALL SELECT concept_id, ingredient_text || ' ' || s || ' ' || ro.x || ' ' || fr.x, 'full_medication_order' FROM sv JOIN ro USING (dose_form), fr WHERE tty <> 'SCDC'
UNION ALL SELECT concept_id, ingredient_text || ' ' || s || ' 1 viên/ngày', 'full_medication_order' FROM sv WHERE dose_form = 'oral_tablet' AND tty <> 'SCDC'
UNION ALL SELECT concept_id, brand || ' ' || s, 'brand_strength' FROM sv WHERE tty = 'SBD' AND brand IS NOT NULL)"""


@query("t5_surface_expand_cross", f"WITH {_SURFACES} SELECT concept_id, text, profile FROM surf")
def _(read):
    return catalog.drug_surfaces(concepts(read)).select("concept_id", "text", "profile")


@query("t6_surface_last_wins", f"WITH {_SURFACES} SELECT lower(text) AS k, concept_id, count(*) AS n FROM surf GROUP BY ALL")
def _(read):
    from pyspark.sql import Window as W

    s = catalog.drug_surfaces(concepts(read)).withColumn("k", F.lower("text")).withColumn("n", F.count("*").over(W.partitionBy("k", "concept_id")))
    return catalog.last_wins(s, ["k", "concept_id"], "ordinal").select("k", "concept_id", "n")


@query("t7_family_groups", f"""WITH {_CONCEPT}, f AS (SELECT lower(trim(ingredient_text, ' .,;:!?()[]{{}}"''')) AS family_id, concept_id, tty FROM cpt)
SELECT family_id, {', '.join(f"coalesce(array_to_string(list_sort(list(concept_id) FILTER (tty IN ({t}))), ','), '') AS {n}" for n, t in (("ingredients", "'IN'"), ("strength_components", "'SCDC'"), ("clinical_drugs", "'SCD', 'SBD'"), ("brands", "'BN'")))} FROM f GROUP BY family_id""")
def _(read):
    f = catalog.families(concepts(read))
    return f.select("family_id", *[F.array_join(c, ",").alias(c) for c in f.columns if c != "family_id"])


_TREAT = """tr AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'Surgery of ' || p_name ELSE p_name || '.' END AS text FROM part), sf AS (SELECT lower(p_name) AS k, count(DISTINCT p_brand) AS n, min(p_brand) AS c FROM part GROUP BY 1)"""


@query("t8_unique_match_resolution", f"""WITH {_TREAT}, r AS (SELECT id, text, n, c, lower(trim(text, '. ')) AS k FROM tr LEFT JOIN sf ON sf.k = lower(trim(text, '. ')))
SELECT id, CASE WHEN contains(k, 'surgery') THEN 'procedure' WHEN n = 1 THEN 'drug' ELSE 'unresolved' END AS outcome, CASE WHEN NOT contains(k, 'surgery') AND n = 1 THEN c END AS concept_id FROM r""")
def _(read):
    p = read("part")
    t = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("Surgery of "), "p_name")).otherwise(F.concat("p_name", F.lit("."))).alias("text"))
    s = p.select(F.col("p_name").alias("text"), F.col("p_brand").alias("concept_id"))
    return catalog.resolve_treatments(t, s, ("surgery",)).select("id", "outcome", "concept_id")


@query("t9_disease_resolution", """
WITH d AS (SELECT text, row_number() OVER (ORDER BY text) - 1 AS idx FROM (SELECT DISTINCT p_name AS text FROM part)), c AS (SELECT lower(p_name) AS k, count(*) AS n, min(p_partkey)::VARCHAR AS c FROM part GROUP BY 1)
SELECT text, idx, CASE WHEN n = 1 THEN c END AS concept_id FROM d LEFT JOIN c ON c.k = lower(text)""")
def _(read):
    p = read("part")
    c = p.select(F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("concept_id"))
    return catalog.resolve_diseases(p.select(F.col("p_name").alias("text")), c).select("text", F.col("index").cast("long").alias("idx"), "concept_id")


@query("t10_cross_type_anti", "SELECT p_partkey, lower(p_name) IN (SELECT lower(p_name) FROM part WHERE p_size < 10) AS rejected FROM part WHERE p_size >= 10")
def _(read):
    p = read("part").select("p_partkey", "p_size", F.col("p_name").alias("text"))
    bad, good = catalog.reject_collisions(p.where("p_size >= 10"), p.where("p_size < 10"))
    return bad.select("p_partkey", F.lit(True).alias("rejected")).union(good.select("p_partkey", F.lit(False).alias("rejected")))


@query("t11_renumber", "SELECT text, 'SYM_' || lpad((row_number() OVER (ORDER BY text) - 1)::VARCHAR, 6, '0') AS surface_id FROM (SELECT DISTINCT p_type AS text FROM part)")
def _(read):
    return catalog.seed_ids(read("part").select(F.col("p_type").alias("text")).distinct(), "SYM_")


@query("t13_pool_counts", f"WITH {_SURFACES} SELECT profile, count(*) AS n FROM surf GROUP BY profile")
def _(read):
    return catalog.drug_surfaces(concepts(read)).groupBy("profile").agg(F.count("*").alias("n"))


# ---- marked notes: words of conversations are wrapped in markers ---------------------------------

_MARKED = r"""mk AS (SELECT conv_id * 100 + turn AS case_id, string_split(regexp_replace(text, '[\[\]<>\s]+', ' ', 'g'), ' ') AS w FROM conversations WHERE len(string_split(regexp_replace(text, '[\[\]<>\s]+', ' ', 'g'), ' ')) >= 6),
nt AS (SELECT case_id, w, w[1] || ' [[E0]]' || w[2] || '[[/E0]] ' || w[3] || ' [[N0]]' || w[4] || '[[/N0]] [[E1]]' || w[5] || CASE WHEN case_id % 5 = 0 THEN 'x' ELSE '' END || '[[/E1]]' || CASE WHEN case_id % 7 = 0 THEN ' [[E9]]q[[/E9]]' ELSE '' END AS marked_text FROM mk)"""


def marked(read):
    w = F.split(F.regexp_replace("text", "[\\[\\]<>\\s]+", " "), " ")
    rows = read("conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("case_id"), w.alias("w")).where(F.size("w") >= 6)
    g = lambda i: F.get("w", F.lit(i))
    text = F.concat(g(0), F.lit(" [[E0]]"), g(1), F.lit("[[/E0]] "), g(2), F.lit(" [[N0]]"), g(3), F.lit("[[/N0]] [[E1]]"), g(4), F.when(F.col("case_id") % 5 == 0, "x").otherwise(""), F.lit("[[/E1]]"), F.when(F.col("case_id") % 7 == 0, " [[E9]]q[[/E9]]").otherwise(""))
    return rows.select("case_id", "w", text.alias("marked_text"))


@query("q1_marker_check", f"""WITH {_MARKED}, e AS (SELECT case_id, 'E1' AS marker_id, 'changed' AS error FROM nt WHERE case_id % 5 = 0 UNION ALL SELECT case_id, 'E9', 'unknown' FROM nt WHERE case_id % 7 = 0 UNION ALL SELECT case_id, 'E5', 'missing' FROM nt WHERE case_id % 3 = 0) SELECT * FROM e""")
def _(read):
    m = marked(read)
    wanted = m.select("case_id", F.explode(F.create_map(F.lit("E0"), F.get("w", F.lit(1)), F.lit("E1"), F.get("w", F.lit(4)), F.lit("N0"), F.get("w", F.lit(3)))).alias("marker_id", "surface_text")).union(m.where("case_id % 3 = 0").select("case_id", F.lit("E5"), F.lit("z")))
    return markers.marker_errors(m, wanted)


_POS = f"""WITH {_MARKED} SELECT case_id, 'E0' AS marker_id, (length(w[1]) + 1)::BIGINT AS start, (length(w[1]) + 1 + length(w[2]))::BIGINT AS "end" FROM nt
UNION ALL SELECT case_id, 'E1', (length(w[1]) + length(w[2]) + length(w[3]) + length(w[4]) + 4)::BIGINT, (length(w[1]) + length(w[2]) + length(w[3]) + length(w[4]) + 4 + length(w[5]) + CASE WHEN case_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT FROM nt
UNION ALL SELECT case_id, 'E9', (length(w[1]) + length(w[2]) + length(w[3]) + length(w[4]) + 5 + length(w[5]) + CASE WHEN case_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT, (length(w[1]) + length(w[2]) + length(w[3]) + length(w[4]) + 6 + length(w[5]) + CASE WHEN case_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT FROM nt WHERE case_id % 7 = 0"""


def _long(df):
    return df.select("case_id", "marker_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("q4_marker_strip_offsets", _POS)
def _(read):
    return _long(markers.marker_positions(marked(read)))


@query("q4_marker_strip_udf", _POS)
def _(read):
    return _long(marked(read).select("case_id", F.explode(markers.strip_markers("marked_text")["spans"]).alias("s")).select("case_id", "s.*"))


@query("q2_placeholder_check", f"""WITH {_MARKED} SELECT case_id, 'E1' AS marker_id, 'leaked' AS error FROM nt WHERE case_id % 3 = 0 UNION ALL SELECT case_id, 'E0' AS marker_id, 'repeated' AS error FROM nt WHERE case_id % 2 = 0 UNION ALL SELECT case_id, 'E1', 'missing' FROM nt WHERE case_id % 2 = 1""")
def _(read):
    m = marked(read)
    drafts = m.select("case_id", F.when(F.col("case_id") % 2 == 0, F.lit("a <<E0>> <<E0>> <<E1>>")).otherwise(F.lit("<<E0>> b")).alias("_d"), F.when(F.col("case_id") % 3 == 0, " Q7q").otherwise("").alias("_l")).select("case_id", F.concat("_d", "_l").alias("draft"))
    return markers.placeholder_errors(drafts, m.select("case_id", F.explode(F.create_map(F.lit("E0"), F.lit("p5p"), F.lit("E1"), F.lit("q7Q"))).alias("marker_id", "surface_text")))


@query("q3_expand_placeholders", f"""WITH {_MARKED} SELECT case_id, 'x [[E0]]' || w[2] || '[[/E0]] y [[E1]]' || w[5] || '[[/E1]].' AS t FROM nt""")
def _(read):
    return marked(read).select("case_id", markers.expand_placeholders(F.lit("x <<E0>> y <<E1>>."), F.create_map(F.lit("E0"), F.get("w", F.lit(1)), F.lit("E1"), F.get("w", F.lit(4)))).alias("t"))


@query("q5_next_section_range", """WITH s AS (SELECT conv_id AS case_id, turn AS section_id, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, (sum(length(text)) OVER (PARTITION BY conv_id))::BIGINT AS length FROM conversations)
SELECT case_id, section_id, start, coalesce(lead(start) OVER (PARTITION BY case_id ORDER BY start, section_id), length) AS "end" FROM s""")
def _(read):
    from pyspark.sql import Window as W

    w = W.partitionBy("conv_id")
    s = read("conversations").select(F.col("conv_id").alias("case_id"), F.col("turn").alias("section_id"), F.coalesce(F.sum(F.length("text")).over(w.orderBy("turn").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum(F.length("text")).over(w).alias("length"))
    return markers.section_ranges(s).select("case_id", "section_id", "start", "end")


@query("q6_surface_counts", r"""WITH x AS (SELECT doc_id AS case_id, len(regexp_extract_all(regexp_replace(lower(text), '([\p{L}\p{N}_]+)', ' \1 ', 'g'), ' the '))::BIGINT AS found FROM documents) SELECT case_id, 'the' AS surface_text, found, 1::BIGINT AS wanted FROM x WHERE found <> 1""")
def _(read):
    d = read("documents").select(F.col("doc_id").alias("case_id"), "text")
    return markers.surface_counts(d, d.select("case_id", F.lit("The").alias("surface_text")))


@query("q7_render_quality", "SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(lower(text), 'assertion') THEN 'banned:assertion' END, CASE WHEN contains(lower(text), 'the') THEN 'banned:the' END], lambda x: x IS NOT NULL), ',') AS faults FROM documents")
def _(read):
    return read("documents").select("doc_id", F.array_join(markers.draft_faults("text", ("assertion", "the")), ",").alias("faults"))


@query("g8_template_render", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Bệnh nhân hiện ghi nhận <<E0>>, <<E1>> và <<E2>>.' WHEN 1 THEN 'Bệnh nhân không ghi nhận <<E0>>, nhưng hiện có <<E1>>.' WHEN 2 THEN '- <<E0>>' || chr(10) || '- <<E1>>' || chr(10) || '- <<E2>>' ELSE '- <<E0>>: <<E1>>' END
|| CASE WHEN p_partkey % 3 = 0 THEN chr(10) || 'Ngoài ra, bệnh nhân đã được thực hiện <<N0>> và <<N1>>.' ELSE '' END AS t FROM part""")
def _(read):
    k = F.col("p_partkey") % 4
    scenario = F.when(k == 0, "patient_current_positive").when(k == 1, "mixed_polarity").when(k == 2, "home_medications").otherwise("laboratory_results")
    negative = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("N0"), F.lit("N1"))).otherwise(F.array().cast("array<string>"))
    return read("part").select("p_partkey", markers.render(scenario, F.array(*map(F.lit, ("E0", "E1", "E2"))), negative).alias("t"))


@query("x1_spec_left_join", "WITH n AS (SELECT l_orderkey AS case_id, arg_max(l_partkey, l_linenumber) AS note FROM lineitem GROUP BY 1) SELECT o_orderkey AS case_id, coalesce(note, -1) AS note, note IS NULL AS rejected FROM orders LEFT JOIN n ON n.case_id = o_orderkey")
def _(read):
    """Lines of an order share numbers: arg_max takes the first of them in the table, as its place in the file tells."""
    specs = read("orders").select(F.col("o_orderkey").alias("case_id"))
    rows = read("lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_partkey").alias("note"), F.col("l_linenumber").alias("ordinal"), "_metadata.file_path", "_metadata.row_index")
    good, bad = export.join_specs(specs, rows, ties=("file_path", "row_index"))
    return good.select("case_id", "note", F.lit(False).alias("rejected")).union(bad.select("case_id", F.lit(-1).cast("long"), F.lit(True)))


@query("x4_soft_cue_warnings", """SELECT doc_id, array_to_string(list_filter([CASE WHEN NOT contains(lower(substring(text, 81, 203)), 'no') THEN 'isNegated' END, CASE WHEN NOT contains(lower(substring(text, 81, 203)), 'was') AND doc_id % 2 = 0 THEN 'isHistorical' END], lambda x: x IS NOT NULL), ',') AS w FROM documents""")
def _(read):
    temporal = F.when(F.col("doc_id") % 2 == 0, "current").otherwise("historical")
    w = markers.soft_warnings(F.col("text"), F.lit(200), F.lit(203), F.array(F.lit("isNegated"), F.lit("isHistorical")), temporal, {"isNegated": ("no",), "isHistorical": ("was",)})
    return read("documents").select("doc_id", F.array_join(w, ",").alias("w"))


_SPLIT = """sg AS (SELECT l_orderkey AS id, array_to_string(list_sort(list(DISTINCT l_partkey::VARCHAR)), '|') AS s FROM lineitem GROUP BY 1), sp AS (SELECT id, CASE WHEN ('0x' || substring(sha1(s), 1, 8))::BIGINT % 10000 < 2000 THEN 'val' ELSE 'train' END AS split FROM sg)"""


def _split(read):
    g = read("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.array(F.col("l_partkey").cast("string"))).alias("c"))
    return g.select("id", export.split(export.signature(F.col("c"), F.array(F.lit("")))).alias("split"))


@query("x6_hash_split", f"WITH {_SPLIT} SELECT id, split FROM sp")
def _(read):
    return _split(read)


@query("x9_split_manifest", f"WITH {_SPLIT} SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, round(count(*) FILTER (split = 'train') / count(*)::DOUBLE, 4) AS train_ratio, round(count(*) FILTER (split = 'val') / count(*)::DOUBLE, 4) AS val_ratio FROM sp")
def _(read):
    return export.split_manifest(_split(read))


@query("x8_assertion_markup", f"""WITH {_MARKED} SELECT case_id, w[1] || ' <E0>' || w[2] || '</E0> ' || w[3] || ' ' || w[4] || ' <E1>' || w[5] || CASE WHEN case_id % 5 = 0 THEN 'x' ELSE '' END || '</E1>' || CASE WHEN case_id % 7 = 0 THEN ' <E9>q</E9>' ELSE '' END AS t FROM nt""")
def _(read):
    return marked(read).select("case_id", markers.assertion_markup(F.col("marked_text")).alias("t"))


@query("m2_sample_validation", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'bad_span' WHEN 2 THEN 'empty_label' WHEN 3 THEN 'duplicate' END AS fault FROM part")
def _(read):
    k = F.col("p_partkey") % 5
    span = lambda s, e, label: F.struct(F.lit(s).alias("start"), F.lit(e).alias("end"), F.lit(label).alias("label"))
    ner = F.when(k == 1, F.array(span(0, 3, "X"))).when(k == 2, F.array(span(0, 0, " "))).when(k == 3, F.array(span(0, 1, "X"), span(0, 1, "X"))).otherwise(F.array(span(1, 2, "X")))
    rows = read("part").select("p_partkey", F.when(k == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("tokenized_text"), ner.alias("ner"))
    return validation.sample_errors(rows).select("p_partkey", "fault")


@query("m1_document_samples", f"""WITH {HITS}, h AS (SELECT document_id, count(*) AS n FROM hits WHERE ord <= 60 GROUP BY 1) SELECT d.doc_id::VARCHAR AS document_id, CASE WHEN h.n IS NULL THEN 'no_training_chunks' END AS error, coalesce(h.n, 0)::BIGINT AS n FROM documents d LEFT JOIN h ON h.document_id = d.doc_id::VARCHAR WHERE NOT regexp_matches(text, '[ \t]{{2,}}|\n[ ]|[ ]\n| [,.;:!?)\\]}}]|[(\\[{{] |^\\s|\\s$|\n\n\n')""")
def _(read):
    """Entities of the first windows: every one is in a window (windows overlap more than a word)."""
    d = notes(read).where(~F.regexp_like("text", F.lit("[ \\t]{2,}|\\n[ ]|[ ]\\n| [,.;:!?)\\]}]|[(\\[{] |^\\s|\\s$|\\n\\n\\n"))).withColumn("e", lexicon_words("text"))
    first = F.transform(F.filter("e", lambda x: x["ord"] <= 60), lambda x: F.struct(*[x[c].alias(c) for c in ("start", "end", "text", "entity_type")]))
    out = export.document_samples(d.select("document_id", F.col("text").alias("raw_text"), first.alias("entities")))
    first = F.aggregate(F.flatten(F.transform("samples", lambda s: s["ner"])), F.lit(0), lambda a, x: a + 1)
    return out.select("document_id", "error", F.coalesce(F.when(F.size("samples") == 1, first).otherwise(F.size(F.get("samples", F.lit(0))["ner"])), F.lit(0)).cast("long").alias("n"))


@query("m4_seeded_split", None)
def _(read):
    return export.seeded_split(read("orders").select(F.col("o_orderkey").alias("id")), 0.1, 42)


@query("m8_dry_run_stats", f"WITH {HITS}, s AS (SELECT document_id, count(*) AS n FROM hits GROUP BY 1) SELECT count(*) AS samples, max(n) AS most, sum(n)::BIGINT AS entities FROM s")
def _(read):
    s = lexicon_hits(read).groupBy("document_id").agg(F.count("*").alias("n"))
    return s.agg(F.count("*").alias("samples"), F.max("n").alias("most"), F.sum("n").alias("entities"))


_SPEC = """sp AS (SELECT p_partkey AS case_id, 'E' || (p_size % 3) AS entity_id, CASE p_partkey % 4 WHEN 0 THEN '[[x' WHEN 1 THEN ' ' ELSE p_name END AS surface_text, CASE p_partkey % 3 WHEN 0 THEN 'THUỐC' WHEN 1 THEN 'CHẨN_ĐOÁN' ELSE 'TRIỆU_CHỨNG' END AS kind,
CASE p_partkey % 5 WHEN 0 THEN ['isNegated'] WHEN 1 THEN ['odd'] ELSE [] END AS a, CASE p_partkey % 2 WHEN 0 THEN ['J18'] ELSE [] END AS c FROM part)"""


@query("q9_spec_check", f"""
WITH {_SPEC}, f AS (SELECT case_id, entity_id, unnest(list_filter([CASE WHEN trim(surface_text) = '' THEN 'empty_surface' WHEN contains(surface_text, '[[') THEN 'marker_in_surface' END, CASE WHEN list_contains(a, 'odd') THEN 'unknown_assertion' END,
CASE WHEN kind IN ('THUỐC', 'CHẨN_ĐOÁN') AND len(c) = 0 THEN 'candidate_missing' END, CASE WHEN kind = 'TRIỆU_CHỨNG' AND len(c) > 0 THEN 'candidate_not_allowed' END, CASE WHEN kind = 'THUỐC' AND len(c) > 0 THEN 'rxnorm_format' END,
CASE WHEN a <> ['isNegated'] THEN 'scenario_assertions' END], lambda x: x IS NOT NULL)) AS error FROM sp) SELECT case_id, entity_id AS marker_id, error FROM f""")
def _(read):
    k = F.col("p_partkey")
    none = F.array().cast("array<string>")
    rows = read("part").select(
        k.alias("case_id"), F.concat(F.lit("E"), (F.col("p_size") % 3).cast("string")).alias("entity_id"), F.when(k % 4 == 0, "[[x").when(k % 4 == 1, " ").otherwise(F.col("p_name")).alias("surface_text"),
        F.when(k % 3 == 0, "THUỐC").when(k % 3 == 1, "CHẨN_ĐOÁN").otherwise("TRIỆU_CHỨNG").alias("entity_type"), F.when(k % 5 == 0, F.array(F.lit("isNegated"))).when(k % 5 == 1, F.array(F.lit("odd"))).otherwise(none).alias("assertions"),
        F.when(k % 2 == 0, F.array(F.lit("J18"))).otherwise(none).alias("candidates"), F.lit("current").alias("temporal_scope"), F.lit("patient").alias("subject_scope"), F.lit("patient_current_negated").alias("scenario_id"),
        *[F.lit(0).alias(c) for c in ("section_index", "block_index", "entity_index")],
    )
    return synth.entity_spec_errors(rows)


def _pool(read):
    kind = F.when(F.col("p_partkey") % 3 == 0, "THUỐC").when(F.col("p_partkey") % 3 == 1, "CHẨN_ĐOÁN").otherwise("TRIỆU_CHỨNG")
    code = F.when(kind == "CHẨN_ĐOÁN", "J18").otherwise(F.col("p_partkey").cast("string"))
    return read("part").select(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("text"), kind.alias("entity_type"), F.array(code).alias("candidates"))


@query("g6_generate_cases", None)
def _(read):
    pool = _pool(read)
    return synth.generate_cases(pool.sparkSession, 200, 42, pool, ["biopsy", "surgery"]).select("case_id", "profile", F.size("sections").alias("n_sections"))


@query("g9_render_and_check", "SELECT 'case_' || lpad(i::VARCHAR, 6, '0') AS case_id, '' AS errors FROM range(200) AS t(i)")
def _(read):
    """Rendered cases pass every check."""
    pool = _pool(read)
    specs = synth.generate_cases(pool.sparkSession, 200, 42, pool, ["biopsy", "surgery"])
    return synth.validate_cases(specs, synth.render_cases(specs)).select("case_id", F.array_join("errors", "; ").alias("errors"))
