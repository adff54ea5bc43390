"""Clinical fixtures: assertions, linking, drug rules, samples, offsets, files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from notara.functions import text as t
from notara.operators import assertion, catalog, chunks, export, linking, markers, ner, spans, validation
from notara.plans.pipeline import Pipeline
from notara.schemas import DIAGNOSIS, DRUG, SYMPTOM
from notara.sources import readers, sinks
from notara.streaming import notes as stream


def one(spark, text, *entities):
    docs = spark.createDataFrame([("n", text)], "document_id string, raw_text string")
    rows = [("n", i, kind, text.index(s), text.index(s) + len(s), s) for i, (s, kind) in enumerate(entities)]
    return docs, spark.createDataFrame(rows, "document_id string, entity_index int, entity_type string, start int, end int, text string")


def labels(spark, text, *entities):
    return {r["text"]: (r["assertions"], r["assertion_confidence"]) for r in assertion.detect(*one(spark, text, *entities)).collect()}


def test_contrast_stops_negation(spark):
    got = labels(spark, "Bệnh nhân không đau đầu, nhưng có chóng mặt.", ("đau đầu", SYMPTOM), ("chóng mặt", SYMPTOM))
    assert got == {"đau đầu": (["isNegated"], 0.97), "chóng mặt": ([], 1.0)}


def test_history_both_ways(spark):
    got = labels(spark, "Tiền sử tăng huyết áp. Đau ngực cách đây 5 năm.", ("tăng huyết áp", DIAGNOSIS), ("Đau ngực", SYMPTOM))
    assert got["tăng huyết áp"] == (["isHistorical"], 0.98)
    assert got["Đau ngực"] == (["isHistorical"], 0.8763)


def test_family_and_unsupported_type(spark):
    got = labels(spark, "Mẹ bị đái tháo đường, bệnh nhân khỏe mạnh.", ("đái tháo đường", DIAGNOSIS))
    assert got["đái tháo đường"] == (["isFamily"], 0.94)
    assert labels(spark, "không WBC", ("WBC", "TÊN_XÉT_NGHIỆM"))["WBC"] == ([], 1.0)


def test_verifier_sees_doubtful_rows_only(spark):
    docs, e = one(spark, "loại trừ viêm phổi", ("viêm phổi", DIAGNOSIS))
    rows = assertion.detect(docs, e).drop("evidence").join(docs, "document_id")
    got = assertion.verify(rows, lambda text, entity, a, c: ([], 0.5)).first()
    assert (got["assertions"], got["assertion_confidence"], got["assertion_source"]) == ([], 0.5, "local_verifier")
    assert assertion.parse_verdict('x {"isNegated": true, "isFamily": "yes", "confidence": 3}', [], 0) == (["isNegated"], 1.0)
    assert assertion.parse_verdict("nothing", ["a"], 0.4) == (["a"], 0.4)


@pytest.fixture(scope="module")
def icd(spark):
    rows = [("I10", "Tăng huyết áp nguyên phát", ["cao huyết áp", "tăng huyết áp"], ""), ("I11", "Bệnh tim do tăng huyết áp", [], ""), ("J18", "Viêm phổi, tác nhân không xác định", ["viêm phổi cộng đồng"], "")]
    return spark.createDataFrame([(*r, "ICD10") for r in rows], "code string, name string, aliases array<string>, description string, ontology string")


def linked(spark, icd, mention, context):
    m = spark.createDataFrame([(1, mention, context)], "query_id int, mention string, context string")
    return linking.link(m, icd, "ICD10").first()


def test_exact_alias(spark, icd):
    got = linked(spark, icd, "cao huyết áp", "Bệnh nhân bị cao huyết áp")
    assert (got["selected_code"], got["method"], got["confidence"]) == ("I10", "exact_alias", 1.0)


def test_fuzzy_and_not_found(spark, icd):
    got = linked(spark, icd, "viêm phổi mắc phải cộng đồng", "Chẩn đoán viêm phổi mắc phải cộng đồng")
    assert got["candidates"][0] == "J18"
    assert linked(spark, icd, "zzz", "qqq")["method"] == "not_found"


def test_mention_key(spark):
    df = spark.createDataFrame([("Đái Tháo-Đường  ß",), ("Viêm phổi",)], "s string")
    for r in df.select("s", t.mention_key("s").alias("a"), t.mention_key_udf("s").alias("b")).collect():
        assert r["a"] == r["b"] == t.mention_key_py(r["s"])


DRUGS = ["aspirin", "metoprolol succinate", "caffeine"]


def drugs(spark, text):
    docs = spark.createDataFrame([("n", text)], "document_id string, text string")
    return [r["text"] for r in ner.drug_predictions(docs, DRUGS).orderBy("start").collect()]


def test_drug_rules(spark):
    note = "Thuốc trước khi nhập viện\n- Aspirin 81mg SCDC\n- metoprolol succinate 100mg daily\n- Lasix 40mg S-C\n2. Bệnh sử hiện tại\nMột ngày uống nhiều caffeine từ cà phê\n"
    assert drugs(spark, note) == ["Aspirin", "metoprolol succinate", "Lasix"]
    assert drugs(spark, "Bệnh nhân được cho Aspirin 325mg tại khoa cấp cứu.") == ["Aspirin"]
    assert drugs(spark, "Thuốc trước khi nhập viện: aspirin 81mg SCDC") == ["aspirin"]


def test_pipeline_end_to_end(spark, icd):
    docs = spark.createDataFrame([("1", "Tiền sử tăng huyết áp.")], "document_id string, raw_text string")
    model = ner.Lexicon({"tăng huyết áp": (DIAGNOSIS, 0.9)})
    got = Pipeline(model, ontologies={DIAGNOSIS: ("ICD10", icd)}, drug_names=DRUGS).run(docs).first()
    assert got["error"] is None
    assert json.loads(got["output"]) == {"note_id": "1", "entities": [{"text": "tăng huyết áp", "type": DIAGNOSIS, "position": [8, 21], "assertions": ["isHistorical"], "candidates": ["I10"]}]}


def test_unavailable_model_isolates_every_note(spark):
    docs = spark.createDataFrame([(str(i), "x y") for i in range(5)], "document_id string, raw_text string")
    got = Pipeline(ner.Unavailable()).run(docs).collect()
    assert all(json.loads(r["output"])["entities"] == [] and "RuntimeError" in r["error"] for r in got) and len(got) == 5


def test_chunks(spark):
    text = "w0 w1 w2 w3 w4 w5 w6 w7 w8 disease w10"
    docs = spark.createDataFrame([("n", text), ("e", " "), ("z", None)], "document_id string, text string")
    got = [r["chunk_text"] for r in chunks.word_chunks(docs, 5, 2).orderBy("chunk").collect()]
    assert got == ["w0 w1 w2 w3 w4", "w3 w4 w5 w6 w7", "w6 w7 w8 disease w10"]
    with pytest.raises(ValueError):
        chunks.check(10, 10)


OFFSETS = ["", "  á…b ", "a\r\n\r\n\r\n\r\nb , c", "x​y ﻿z", "😀 ( a )", "́x", "é…—×\t\tq "]


@pytest.mark.parametrize("raw", OFFSETS)
def test_offset_map(raw):
    text, at = t.normalize_with_map(raw)
    assert len(text) == len(at) and at == sorted(at) and all(0 <= x < len(raw) for x in at)
    assert t.normalize_with_map(text)[0] == text


def test_normalized_text():
    assert t.normalize_with_map(" a  ,b\r\n \n\n\n(  c ) …")[0] == "a,b\n\n(c)..."
    assert t.normalize_with_map("a\u0301b") == ("\u00e1b", [0, 2])


def test_samples(spark):
    e = "array<struct<text:string,start:int,end:int,entity_type:string>>"
    rows = [
        ("ok", "  Bệnh   nhân đau đầu . ", [("đau đầu", 14, 21, SYMPTOM)]), ("mismatch", "đau đầu", [("sai", 0, 3, SYMPTOM)]), ("mid", "foobar", [("foo", 0, 3, SYMPTOM)]),
        ("none", "a b", []), ("type", "a b", [("a", 0, 1, "X")]), ("bounds", "a b", [("a", 0, 9, SYMPTOM)]), ("blank", "  ", []), ("twice", "a b", [("a", 0, 1, SYMPTOM)] * 2),
    ]
    got = {r["document_id"]: r for r in export.document_samples(spark.createDataFrame(rows, f"document_id string, raw_text string, entities {e}")).collect()}
    assert {k: r["error"] for k, r in got.items()} == {"ok": None, "mismatch": "raw_text_mismatch", "mid": "token_alignment_error", "none": "no_training_chunks", "type": "invalid_entity_type", "bounds": "raw_span_out_of_bounds", "blank": "empty_normalized_text", "twice": "duplicate_entity"}
    s = got["ok"]["samples"][0]
    assert s["tokenized_text"] == ["Bệnh", "nhân", "đau", "đầu", "."] and [tuple(x) for x in s["ner"]] == [(2, 3, SYMPTOM)]


def test_splits(spark):
    df = spark.createDataFrame([("I10",), ("",)], "s string")
    assert [r[0] for r in df.select(t.split_bucket("s")).collect()] == [4011, 606]
    ids = spark.range(4)
    a, b = (sorted((r["id"], r["split"]) for r in export.seeded_split(ids, 0.25, 7).collect()) for _ in range(2))
    assert a == b and sum(x == "eval" for _, x in a) == 1
    with pytest.raises(ValueError):
        export.seeded_split(spark.range(1), 0.5, 1)


def test_greedy_overlap(spark):
    rows = [("d", 0, "A", 0, 5, 0.9), ("d", 1, "A", 4, 8, 0.95), ("d", 2, "B", 8, 9, 0.2), ("d", 3, "A", 0, 3, 0.9), ("d", 4, "A", 4, 8, 0.5)]
    p = spark.createDataFrame(rows, "document_id string, ord int, entity_type string, start int, end int, confidence double")
    got = sorted((r["start"], r["end"]) for r in spans.postprocess(p).collect())
    assert got == [(0, 3), (4, 8)]


def test_markers_and_rendering(spark):
    m = spark.createDataFrame([("c", "a [[E0]]đau[[/E0]] [[N0]]x[[/N0]] [[E1]]ho[[/E1]].")], "case_id string, marked_text string")
    got = {r["marker_id"]: (r["start"], r["end"]) for r in markers.marker_positions(m).collect()}
    assert got == {"E0": (2, 5), "E1": (8, 10)} and markers.strip_markers_py(m.first()["marked_text"])[0] == "a đau x ho."
    f = spark.range(1).select(markers.render(F.lit("family_current"), F.array(F.lit("E0"), F.lit("E1")), F.array().cast("array<string>"))).first()[0]
    assert f == "Người nhà bệnh nhân hiện có <<E0>> và <<E1>>."


def test_surface_verdict_defaults(spark):
    rows = [("o lắng", SYMPTOM), ("không sốt", SYMPTOM), ("có sốt", SYMPTOM), ("gập vào trong", SYMPTOM), ("đau đầu,", SYMPTOM), ("ab", DIAGNOSIS), (" none ", DIAGNOSIS)]
    df = spark.createDataFrame(rows, "s string, k string")
    got = [tuple(r) for r in df.select(*catalog.surface_verdict("s", "k")).collect()]
    assert got == [("lo lắng", None), (None, "embedded_assertion_cue"), (None, "contextual_prefix"), (None, "incomplete_directional_fragment"), ("đau đầu", None), (None, "too_short"), (None, "empty")]


def test_files(spark, tmp_path):
    for name in ("10", "2", "1", "b"):
        (tmp_path / f"{name}.txt").write_text("﻿ho " + name, encoding="utf-8")
    docs = readers.read_text_notes(spark, str(tmp_path / "*.txt"))
    assert [r["document_id"] for r in docs.withColumnRenamed("document_id", "stem").orderBy(*readers.natural_order()).withColumnRenamed("stem", "document_id").collect()] == ["1", "2", "10", "b"]
    assert docs.where("document_id = '1'").first()["raw_text"] == "ho 1"
    (tmp_path / "x.jsonl").write_text('{"text": "a"}\n\nbad\n{"note": "b", "id": 7}\n', encoding="utf-8")
    good, bad = readers.json_lines(spark, str(tmp_path / "x.jsonl"), "text string, note string, id string", strict=False)
    assert sorted(r["line"] for r in good.collect()) == [1, 4] and [r["line"] for r in bad.collect()] == [3]
    with pytest.raises(Exception, match="bad line 3"):
        readers.json_lines(spark, str(tmp_path / "x.jsonl"), "text string")[0].collect()
    out = spark.createDataFrame([("2", '{"a": 1}'), ("1", "{}")], "note_id string, output string")
    assert sinks.write_zip(out, str(tmp_path / "o.zip")) == 2
    assert zipfile.ZipFile(tmp_path / "o.zip").namelist() == ["output/1.json", "output/2.json"]
    with pytest.raises(ValueError):
        sinks.check_paths("a", "a")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"note_id": "1", "text": "x", "received": "2024-01-01T00:00:00Z"}\n' * 2)
    seen = []
    q = stream.run(stream.drop_repeats(stream.read_notes(spark, str(tmp_path / "in"))), lambda df: df.select("note_id"), lambda df, n: seen.extend(r[0] for r in df.collect()), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert seen == ["1"]


def test_output_errors(spark):
    docs = [("d", 0, "abc", "X", 0, 1, "a"), ("d", 1, "abc", DRUG, 0, 9, "a"), ("d", 2, "abc", DRUG, 1, 2, "z")]
    e = spark.createDataFrame(docs, "document_id string, entity_index int, raw_text string, entity_type string, start int, end int, text string").withColumns({"assertions": F.array(F.lit("nope")), "candidates": F.array(F.lit("1"))})
    got = validation.validate_documents(validation.output_errors(e)).first()
    assert not got["valid"] and got["warnings"] == ["candidates_dropped"]
    assert got["errors"] == ["unknown_type", "unknown_assertions:nope", "out_of_bounds", "text_mismatch", "unknown_assertions:nope"]


def test_run_files(spark, tmp_path):
    """An output for every note, failed ones included, in natural order; error rows; packaging of an existing file."""
    docs = spark.createDataFrame([("10", "x"), ("2", "y"), ("1", "z")], "document_id string, raw_text string")
    out = Pipeline(ner.Unavailable()).run(docs)
    sources = docs.select(F.col("document_id").alias("note_id"), F.concat(F.lit("in/"), "document_id").alias("source_path"))
    sinks.write_run(out, str(tmp_path / "p"), str(tmp_path / "e"), sources)
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert sorted(x["note_id"] for x in lines) == ["1", "10", "2"] and all(x["entities"] == [] for x in lines)
    bad = spark.read.json(str(tmp_path / "e")).collect()
    assert {(r["note_id"], r["source_path"], r["error_type"], r["message"]) for r in bad} == {(i, f"in/{i}", "RuntimeError", "the model is not available") for i in ("1", "2", "10")}
    assert sinks.package_predictions(spark, str(tmp_path / "p"), str(tmp_path / "o.zip")) == 3
    with zipfile.ZipFile(tmp_path / "o.zip") as z:
        assert z.namelist() == ["output/1.json", "output/2.json", "output/10.json"] and json.loads(z.read("output/2.json")) == {"note_id": "2", "entities": []}
    (tmp_path / "q.jsonl").write_text('{"note_id":"2","entities":[]}\n\n{"note_id":"1","entities":[]}\n')
    assert sinks.package_predictions(spark, str(tmp_path / "q.jsonl"), str(tmp_path / "r.zip")) == 2
    (tmp_path / "q.jsonl").write_text('{"note_id":"2"}\n{"note_id":"2"}\n')
    with pytest.raises(ValueError, match="repeated"):
        sinks.package_predictions(spark, str(tmp_path / "q.jsonl"), str(tmp_path / "r.zip"))
    with pytest.raises(ValueError):
        sinks.package_predictions(spark, "a", "./a")


def test_text_and_validation_block(spark):
    e = spark.createDataFrame([("d", 0, "ab", SYMPTOM, 0, 1, "a"), ("d", 1, "ab", SYMPTOM, 0, 9, "z")], "document_id string, entity_index int, raw_text string, entity_type string, start int, end int, text string").withColumns({"assertions": F.array().cast("array<string>"), "candidates": F.array().cast("array<string>")})
    checked = validation.validate_documents(validation.output_errors(e))
    got = json.loads(validation.serialize(e, checked=checked, texts=e.select("document_id", "raw_text").distinct()).first()["output"])
    assert got["text"] == "ab" and got["validation"] == {"valid": False, "errors": ["out_of_bounds"], "warnings": []} and len(got["entities"]) == 2
    strict = validation.serialize(e, strict=True, checked=checked).first()
    assert strict["output"] is None and strict["error"] == "out_of_bounds"
    docs = spark.createDataFrame([("1", 'a "q" und'), ("2", None)], "document_id string, raw_text string")
    out = {r["note_id"]: json.loads(r["output"]) for r in Pipeline(ner.Lexicon({"und": (SYMPTOM, 0.9)}), include_text=True).run(docs).collect()}
    assert out["1"]["text"] == 'a "q" und' and out["1"]["entities"][0]["position"] == [6, 9] and out["2"]["entities"] == []


def test_model_runs_once(spark):
    """A model whose answers change from call to call gives one consistent note."""
    runs = spark.sparkContext.accumulator(0)

    class Counted:
        def predict_entities(self, text, labels, **_):
            runs.add(1)
            return [{"start": 0, "end": 1, "label": SYMPTOM, "score": 0.9}]

    docs = spark.createDataFrame([(str(i), "x y") for i in range(6)], "document_id string, raw_text string")
    plan = Pipeline(Counted()).run(docs)
    assert plan.count() == 6 and len(plan.collect()) == 6 and runs.value == 6
    assert plan._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 0


def test_overlap_runs_match_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(f"d{i % 5}", i, "A", s, s + rng.randint(1, 9), rng.choice([0.5, 0.7, 0.9])) for i in range(400) for s in [rng.randint(0, 300)]]
    df = spark.createDataFrame(rows, "document_id string, first_ord int, entity_type string, start int, end int, confidence double")
    got = sorted((r["document_id"], r["first_ord"]) for r in spans.resolve_overlaps(df).collect())
    want = []
    for d in sorted({r[0] for r in rows}):
        taken = []
        for r in sorted((r for r in rows if r[0] == d), key=lambda r: (-r[5], r[3] - r[4], r[1])):
            if not any(r[3] < e and s < r[4] for s, e in taken):
                taken.append((r[3], r[4]))
                want.append((d, r[1]))
    assert got == sorted(want)


def test_build_samples(spark, tmp_path):
    e = "array<struct<text:string,start:int,end:int,entity_type:string>>"
    rows = [("good", "bệnh nhân sốt", [("sốt", 10, 13, SYMPTOM)]), ("bad", "đau đầu", [("sai", 0, 3, SYMPTOM)]), ("label", "a b", [("a", 0, 1, " ")]), ("none", None, []), ("cut", "a  b", [("a ", 0, 2, SYMPTOM)])]
    docs = spark.createDataFrame(rows, f"document_id string, raw_text string, entities {e}")
    samples, bad = export.build_samples(docs, str(tmp_path / "errors"))
    assert [r["id"] for r in samples.collect()] == ["good#0"]
    assert {r["document_id"]: r["code"] for r in spark.read.json(str(tmp_path / "errors")).collect()} == {"bad": "raw_text_mismatch", "label": "invalid_entity_label", "none": "invalid_document", "cut": "normalized_text_mismatch"}
    with pytest.raises(export.InvalidDocument, match="bad: raw_text_mismatch"):
        export.build_samples(docs, str(tmp_path / "errors"), on_error="raise")
    with pytest.raises(ValueError):
        export.build_samples(docs, on_error="stop")


def test_seeded_split_takes_the_least_hashes(spark):
    df = spark.range(3000)
    hashed = sorted((r[0], r[1]) for r in df.select(F.xxhash64(F.lit(5), F.col("id")), "id").collect())
    got = {r["id"] for r in export.seeded_split(df, 0.1, 5).where("split = 'eval'").collect()}
    assert got == {i for _, i in hashed[:300]}


def test_drug_names_longest_first():
    names = ner.DrugNames(["aspirin", "Aspirin EC", "vitamin b-12", "vitamin b", ""])
    line = "Aspirin EC 81mg, aspirins, VITAMIN B-12x vitamin B, aspirin."
    assert [line[a:b] for a, b in names.finditer(line)] == ["Aspirin EC", "VITAMIN B", "vitamin B", "aspirin"]


def test_adapters_and_answers():
    from notara.operators import models

    class Config:
        url, model, key, timeout, max_tokens, temperature, repair_temperature, top_p = "http://127.0.0.1:9", "m", "", 1, 5, 0.1, 0.1, 0.9

    assert models.first_object('x {"code": "A"} {"code": "B"}') == {"code": "A"} and models.first_object("{no}") is None and models.first_object("[1]") is None
    with pytest.raises(OSError):
        models.ChatClient(Config())("hi")
    assert assertion.parse_verdict('{"isFamily": true, "confidence": 7}', ["isNegated"], 0.5) == (["isFamily"], 1.0) and assertion.parse_verdict("none", ["isNegated"], 0.5) == (["isNegated"], 0.5)


def test_difflib_rerank_matches_python(spark):
    from difflib import SequenceMatcher

    rows = [(1, "đau dau", "ICD10 entity: đau dau\nContext: x", c, n, al, "d", i + 1) for i, (c, n, al) in enumerate([("A", "đau đầu", ["dau"]), ("B", "sốt", None), ("C", "ĐAU ĐẦU cấp", [])])]
    df = spark.createDataFrame(rows, "query_id int, mention string, query string, code string, name string, aliases array<string>, description string, rank int")
    got = {r["code"]: r["final_score"] for r in linking.lexical_rerank(df).collect()}
    for _, m, q, c, n, al, d, _ in rows:
        key = t.mention_key_py
        ratio = max(SequenceMatcher(None, key(m), key(x)).ratio() for x in [n, *(al or [])])
        a, b = set(key(q).split()), set(key(" ".join([n, *(al or []), d])).split())
        assert abs(got[c] - (0.75 * ratio + 0.25 * len(a & b) / len(a | b))) < 1e-9


def test_dense_blocks_match_numpy(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 8))
    v[7] = 0
    df = spark.createDataFrame([(i, f"c{i:02d}", [float(x) for x in r]) for i, r in enumerate(v)], "query_id int, code string, vector array<double>")
    monkeypatch.setattr(linking, "QUERY_BLOCK", 16)
    monkeypatch.setattr(linking, "ENTRY_BLOCK", 25)
    got = {}
    for r in linking.dense(df.select("query_id", "vector"), df.select("code", "vector"), 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["code"], r["score"])
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for i in range(60):
        order = sorted(range(60), key=lambda j: (-round(float(u[i] @ u[j]), 9), j))[:5]
        assert [got[i][k + 1][0] for k in range(5)] == [f"c{j:02d}" for j in order]


def test_warning_on_a_narrow_stream():
    import io

    raw = io.BytesIO()
    out = io.TextIOWrapper(raw, encoding="ascii")
    sinks.warn("sốt", out)
    out.flush()
    assert raw.getvalue() == b"warning: s\\u1ed1t\n"


def test_draft_leaks():
    from notara.operators import synth

    assert synth.draft_errors("<<E0>> và đau  đầu", {"E0": "Đau đầu"}) == ["E0: leaked"] and synth.draft_errors("<<E0>> đau đầux", {"E0": "đau đầu"}) == []
