"""What keeps a query within its memory and its shuffles, and rows that small tables do not have."""

import os

import pytest
from pyspark.sql import functions as F

from notara import queries
from notara.functions import text as t
from notara.operators import export, metrics

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def written(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@needs_tables
def test_batches_of_notes_are_bounded(spark):
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    queries.QUERIES["n_normalize_udf"](spark, SF)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2_000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


@needs_tables
@pytest.mark.parametrize("name", ["n12_span_to_raw", "n13_span_to_normalized", "m1_document_samples", "t1_mention_explode"])
def test_texts_meet_their_words_without_a_shuffle(spark, name):
    p = plan(queries.QUERIES[name](spark, SF))
    assert "Join" not in p and "Aggregate" not in p


def test_spans_to_normalized_has_null_for_null_and_bad_spans(spark):
    rows = spark.createDataFrame([([0, 2, 2, 5], [(0, 1), (1, 2), (2, 6)]), ([], []), ([3], None)], "m array<int>, s array<struct<start:int,end:int>>")
    assert [r[0] if r[0] is None else [x and tuple(x) for x in r[0]] for r in rows.select(t.spans_to_normalized("m", "s")).collect()] == [[(0, 1), None, (1, 4)], [], None]


def test_composed_keeps_nulls(spark):
    from notara.queries.texts import composed

    rows = spark.createDataFrame([("é",), (None,), ("Å",)], "raw string")
    assert [r[0] for r in rows.select(composed("raw")).collect()] == ["é", None, "Å"]


def test_large_pools_give_the_same_cases(spark, monkeypatch):
    from notara.operators import synth

    kinds = ("THUỐC", "CHẨN_ĐOÁN", "TRIỆU_CHỨNG")
    rows = [(f"s {i % 40}", kinds[i % 3], [str(i % 7)] if i % 5 else None) for i in range(150)]
    pool = spark.createDataFrame(rows, "text string, entity_type string, candidates array<string>")
    cases = lambda: sorted(map(repr, synth.generate_cases(spark, 40, 7, pool, ["biopsy"]).collect()))
    whole = cases()
    monkeypatch.setattr(synth, "MOST_POOL", 10)
    assert cases() == whole


def test_codes_of_a_key_are_counted_before_the_join(spark):
    from notara.operators import linking

    mentions = spark.createDataFrame([(1, "Aspirin !"), (2, "none"), (3, "ASPIRIN"), (3, "x")], "query_id long, mention string")
    index = spark.createDataFrame([("aspirin", "9"), ("aspirin", "10"), ("x", "2")], "alias_key string, code string")
    out = linking.exact_counts(mentions, index)
    assert sorted(map(tuple, out.collect())) == [(1, 2, "10"), (3, 3, "10")]
    p = plan(out)
    assert p.rindex("Aggregate [alias_key") > p.index("Join")  # below it


def test_first_of_tied_notes_wins(spark):
    specs = spark.createDataFrame([(1,), (2,)], "case_id long")
    rows = spark.createDataFrame([(1, 7, 2, 5), (1, 8, 2, 4), (1, 9, 1, 0)], "case_id long, note long, ordinal int, place int")
    good, bad = export.join_specs(specs, rows, ties=("place",))
    assert [tuple(r) for r in good.collect()] == [(1, 8)] and [r[0] for r in bad.collect()] == [2]


def test_tied_lines_go_by_their_place_in_the_table(spark, tmp_path):
    n = 3_000
    lines = spark.range(n).select((F.col("id") % 7).alias("l_orderkey"), ((F.col("id") * 7919) % n).alias("l_partkey"), F.lit(1).alias("l_linenumber"))
    at = written(spark, tmp_path, lineitem=lines, orders=spark.range(7).select(F.col("id").alias("o_orderkey")))
    first = {k: k * 7919 % n for k in range(7)}
    got = {r["case_id"]: r["note"] for r in queries.QUERIES["x1_spec_left_join"](spark, at).collect()}
    assert got == first


def test_an_empty_key_is_one_token_as_in_sql(spark, tmp_path):
    texts = spark.createDataFrame([(1, "..."), (2, ""), (3, "a b"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in queries.QUERIES["f5_token_count"](spark, written(spark, tmp_path, documents=texts)).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: None}


def test_null_keys_match_nothing(spark):
    rows = spark.createDataFrame([("a", 0, 1, "T"), (None, 0, 1, "T")], "document_id string, start int, end int, entity_type string")
    out = metrics.exact_scores(rows, rows)
    assert tuple(out.select("tp", "fp", "fn").first()) == (1, 1, 1)
    assert "Join" not in plan(out)


@needs_tables
def test_entities_are_numbered_before_they_meet_their_text(spark):
    p = plan(queries.QUERIES["v1_output_validation"](spark, SF))
    assert p.index("Join") < p.index("Window")  # the window is below the join


def test_overlaps_match_as_the_definition_says():
    import random

    rng = random.Random(3)
    for _ in range(500):
        g, p = (sorted({(s, s + rng.randint(1, 9)) for s in (rng.randint(0, 30) for _ in range(rng.randint(0, 12)))}) for _ in range(2))
        free = list(p)
        for s, e in g:
            hit = next((y for y in free if y[0] < e and s < y[1]), None)
            if hit:
                free.remove(hit)
        assert metrics.matched(g, p) == len(p) - len(free)
    many = [(i, i + 1) for i in range(0, 200_000, 2)]
    assert metrics.matched(many, many) == len(many)


def test_mentions_are_cut_by_place(spark):
    from notara.operators import catalog

    rows = spark.createDataFrame([("a", "ăb cd", [(0, 2, "DISEASE"), (3, 9, "SYMPTOM"), (3, 5, "x")]), ("b", None, [(0, 1, "x")]), ("c", "x", None)], "id string, text string, label array<struct<start:int,end:int,type:string>>")
    out = catalog.mentions(rows)
    assert [(r["id"], r["index"], r["surface"]) for r in out.orderBy("id", "index").collect()] == [("a", 0, "ăb"), ("a", 1, None), ("a", 2, "cd"), ("b", 0, None)]
    assert "substring" not in plan(out)
