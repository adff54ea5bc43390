"""Queries of readers and writers: a table is written as files to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import DIAGNOSIS, DRUG
from ..sources import datasets, readers, sinks
from ..tables import new_path
from ._base import query


def _path(df, name: str, suffix: str = "") -> str:
    return new_path(df.sparkSession, name) + suffix


@query("s1_text_files", "SELECT r_regionkey::VARCHAR AS document_id, r_name || chr(10) || 'x' || chr(10) AS raw_text, NULL::VARCHAR AS error FROM region UNION ALL SELECT 'blank', ' ' || chr(10), 'blank_text'")
def _(read):
    """One text file for each region, with a byte order mark, and a blank one."""
    rows = read("region").select(F.col("r_regionkey").cast("string").alias("f"), F.concat(F.lit("\ufeff"), "r_name", F.lit("\nx")).alias("value"))
    spark, path = rows.sparkSession, _path(rows, "notes")
    for name, part in [(str(i), rows.where(F.col("f") == str(i)).select("value")) for i in range(5)] + [("blank", spark.createDataFrame([(" ",)], "value string"))]:
        folder = new_path(spark, "one")
        part.coalesce(1).write.text(folder)
        _move(spark, folder, path, f"{name}.txt")
    return readers.read_text_notes(spark, f"{path}/*.txt").select("document_id", "raw_text", "error")


def _move(spark, folder: str, to: str, name: str) -> None:
    """The only data file of a folder under a name of its own in another folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(to))
    (part,) = [x.getPath() for x in files.globStatus(path(f"{folder}/part-*"))]
    files.rename(part, path(f"{to}/{name}"))


@query("s2_json_records", "SELECT doc_id::VARCHAR AS document_id, text AS raw_text, false AS has_labels FROM documents")
def _(read):
    """JSON lines by way of the dispatch on the suffix."""
    d = read("documents")
    path = _path(d, "records", ".jsonl")
    sinks.write_json(d.select(F.col("doc_id").alias("note_id"), F.col("text").alias("content")), path)
    records = readers.read_records(d.sparkSession, path, "note_id string, content string")
    return readers.to_documents(records.withColumn("line", F.lit(0))).select("document_id", "raw_text", "has_labels")


@query("s3_json_lines", """
SELECT 'good' AS kind, count(*) AS n, sum(o_orderkey)::BIGINT AS key FROM orders WHERE o_orderkey % 50 <> 0 UNION ALL
SELECT 'bad', count(*), 0 FROM orders WHERE o_orderkey % 50 = 0""")
def _(read):
    """Orders as JSON lines; every fiftieth is no JSON, and blank lines stand between."""
    o = read("orders")
    path = _path(o, "lines", ".jsonl")
    bad = F.col("o_orderkey") % 50 == 0
    o.select(F.when(bad, "{no json").otherwise(F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey").cast("string"), F.lit("}\n"))).alias("value")).write.text(path)
    good, wrong = readers.json_lines(o.sparkSession, path, "o_orderkey long", strict=False)
    return good.agg(F.lit("good").alias("kind"), F.count("*").alias("n"), F.sum("o_orderkey").alias("key")).union(wrong.agg(F.lit("bad"), F.count("*"), F.lit(0).cast("long")))


@query("s7_residual_metadata", "SELECT doc_id::VARCHAR AS document_id, json_object('lang', lang, 'n_chars', n_chars, 'source', source)::VARCHAR AS metadata FROM documents")
def _(read):
    records = read("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("note"), "lang", "n_chars", "source", F.lit(1).alias("line"), F.lit("a.json").alias("path"))
    return readers.to_documents(records).select("document_id", "metadata")


@query("k1_write_append", "SELECT o_orderkey, o_totalprice, 2::BIGINT AS n FROM orders")
def _(read):
    """Written once and appended once."""
    o = read("orders").select("o_orderkey", "o_totalprice")
    path = _path(o, "out", ".jsonl")
    sinks.write_json(o, path)
    sinks.write_json(o, path, append=True)
    back = o.sparkSession.read.schema("o_orderkey long, o_totalprice double").json(path)
    return back.groupBy("o_orderkey", "o_totalprice").agg(F.count("*").alias("n"))


@query("k3_run_files", """
SELECT doc_id::VARCHAR AS note_id, '{"note_id":"' || doc_id || '","entities":[]}' AS output, CASE WHEN doc_id % 9 = 0 THEN 'ValueError' END AS error_type, CASE WHEN doc_id % 9 = 0 THEN 'bad: x' END AS message, CASE WHEN doc_id % 9 = 0 THEN 'in/' || doc_id || '.txt' END AS source_path FROM documents""")
def _(read):
    """Predictions of every note, and the error rows of those that failed."""
    d = read("documents").select(F.col("doc_id").cast("string").alias("note_id"))
    results = d.select("note_id", F.concat(F.lit('{"note_id":"'), "note_id", F.lit('","entities":[]}')).alias("output"), F.when(F.col("note_id").cast("long") % 9 == 0, "ValueError: bad: x").alias("error"))
    spark, predictions, errors = d.sparkSession, _path(d, "predictions"), _path(d, "errors")
    sinks.write_run(results, predictions, errors, d.withColumn("source_path", F.concat(F.lit("in/"), "note_id", F.lit(".txt"))))
    lines = spark.read.text(predictions).select(F.get_json_object("value", "$.note_id").alias("note_id"), F.col("value").alias("output"))
    bad = spark.read.schema("note_id string, source_path string, error_type string, message string").json(errors)
    return lines.join(bad, "note_id", "left").select("note_id", "output", "error_type", "message", "source_path")


@query("s14_token_dataset", "SELECT p_partkey, [p_name, p_brand] AS tokenized_text, 0::INTEGER AS start, (p_partkey % 2)::INTEGER AS \"end\", p_type AS label FROM part")
def _(read):
    p = read("part")
    path = _path(p, "samples", ".jsonl")
    ner = F.array(F.array(F.lit("0"), (F.col("p_partkey") % 2).cast("string"), F.concat_ws("#", "p_type", "p_partkey")))
    sinks.write_json(p.select(F.array("p_name", "p_brand").alias("tokenized_text"), ner.alias("ner")), path)
    e = F.get("ner", F.lit(0))
    rows = datasets.token_dataset(p.sparkSession, path).withColumn("l", F.split(e["label"], "#"))
    return rows.select(F.get("l", F.lit(1)).cast("long").alias("p_partkey"), "tokenized_text", e["start"].alias("start"), e["end"].alias("end"), F.get("l", F.lit(0)).alias("label"))


@query("s15_mention_lines", """
SELECT 'good' AS kind, doc_id, 0::INTEGER AS start, length(text)::INTEGER AS "end", lang AS type FROM documents WHERE doc_id % 40 <> 0
UNION ALL SELECT 'bad', count(*), 0, 0, '' FROM documents WHERE doc_id % 40 = 0""")
def _(read):
    d = read("documents")
    path = _path(d, "mentions", ".jsonl")
    label = F.array(F.array(F.lit("0"), F.length("text").cast("string"), F.col("lang")), F.array(F.lit("1")))
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("text"), label.alias("label")))
    d.select(F.when(F.col("doc_id") % 40 == 0, "[1, 2").otherwise(line).alias("value")).write.text(path)
    good, bad = datasets.mention_lines(d.sparkSession, path)
    rows = good.select(F.lit("good").alias("kind"), F.col("text").cast("long").alias("doc_id"), F.explode("label").alias("l")).select("kind", "doc_id", "l.*")
    return rows.union(bad.agg(F.lit("bad"), F.count("*"), F.lit(0), F.lit(0), F.lit("")))


@query("s16_rxnorm_files", """
SELECT p_partkey::VARCHAR AS concept_id, p_name AS name, 'IN' AS tty FROM part UNION ALL SELECT (1000000 + p_partkey)::VARCHAR, p_brand, p_type FROM part""")
def _(read):
    """A bare array of records, and one under `data` with other field names."""
    p = read("part")
    spark, one, two = p.sparkSession, _path(p, "in", ".json"), _path(p, "df", ".json")
    array = lambda *fields: F.to_json(F.collect_list(F.struct(*fields)))
    p.agg(array(F.col("p_partkey").alias("rxcui"), F.col("p_name").alias("name"))).write.text(one)
    p.agg(F.concat(F.lit('{"data": '), array((F.col("p_partkey") + 1_000_000).alias("RXCUI"), F.col("p_brand").alias("str"), F.col("p_type").alias("TTY")), F.lit("}"))).write.text(two)
    return datasets.load_rxnorm(spark, {"IN": one, "DF": two}).select("concept_id", "name", "tty")


_ALIASES = "list_sort(list_distinct([trim(x) for x in {} if trim(x) <> '']))"


@query("s20_rxnorm_mapping", "SELECT p_partkey::VARCHAR AS code, p_name AS name, " + _ALIASES.format("[p_brand, p_type, p_name]") + " AS aliases, p_type AS description, 'RXNORM' AS ontology FROM part")
def _(read):
    p = read("part")
    path = _path(p, "mapping", ".json")
    concept = F.struct(F.col("p_partkey").cast("string").alias("rxcui"), F.col("p_name").alias("name"), F.col("p_type").alias("tty"))
    item = F.struct(F.col("p_brand").alias("original_text"), F.struct(F.col("p_type").alias("drug_name")).alias("parsed"), concept.alias("selected_concept"))
    odd = F.col("p_partkey") % 2 == 1
    p.agg(F.collect_list(F.when(odd, item)).alias("verified"), F.collect_list(F.when(~odd, item)).alias("review")).write.json(path)
    return datasets.load_ontology(p.sparkSession, path, "RXNORM").select("code", "name", "aliases", "description", "ontology")


@query("s18_icd_sheet", "SELECT upper('J' || p_partkey) AS concept_id, p_name AS name_vi, lower(p_name) AS normalized_name FROM part WHERE p_partkey % 10 <> 0")
def _(read):
    """A sheet as CSV with blanks around its column names and null-like values."""
    p = read("part")
    path = _path(p, "sheet", ".csv")
    p.select(F.concat(F.lit("j"), F.col("p_partkey").cast("string")).alias(" Mã "), F.when(F.col("p_partkey") % 10 == 0, "nan").otherwise(F.col("p_name")).alias("Tên bệnh ")).write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.icd_concepts(readers.read_spreadsheet(p.sparkSession, path))


@query("s22_catalog_folder", """
SELECT 'drug_surfaces' AS name, p_partkey::VARCHAR AS surface_id, p_name AS text FROM part UNION ALL SELECT 'symptom_surfaces', s_suppkey::VARCHAR, s_name FROM supplier""")
def _(read):
    """Two of the five tables are written; the others come back empty."""
    p, s = read("part"), read("supplier")
    folder = _path(p, "catalogs")
    tables = {"drug_surfaces": p.select(F.col("p_partkey").cast("string").alias("surface_id"), F.col("p_name").alias("text"), F.lit(DRUG).alias("entity_type")), "symptom_surfaces": s.select(F.col("s_suppkey").cast("string").alias("surface_id"), F.col("s_name").alias("text"), F.lit(DIAGNOSIS).alias("entity_type"))}
    datasets.write_catalogs(tables, folder)
    back = [df.select(F.lit(n).alias("name"), "surface_id", "text") for n, df in datasets.load_catalogs(p.sparkSession, folder).items()]
    out = back[0]
    for df in back[1:]:
        out = out.union(df)
    return out


@query("k7_pool_counts", "SELECT 'drug_surfaces' AS pool, count(*) AS n FROM part UNION ALL SELECT 'symptom_surfaces', count(*) FROM supplier")
def _(read):
    p, s = read("part"), read("supplier")
    return datasets.write_catalogs({"drug_surfaces": p.select(F.col("p_name").alias("text")), "symptom_surfaces": s.select(F.col("s_name").alias("text"))}, _path(p, "catalogs"))
