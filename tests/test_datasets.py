"""Files of samples, mentions, ontologies and settings."""

import json

import pytest

from notara.sources import datasets


def test_token_dataset(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps([{"tokenized_text": ["a", "b"], "ner": [[0, 1, "X"]]}]))
    assert datasets.token_dataset(spark, str(p)).first()["ner"][0]["end"] == 1
    p.write_text(json.dumps([{"tokenized_text": ["a"], "ner": [[0, 1, "X"]]}]))
    with pytest.raises(ValueError, match="bad_span"):
        datasets.token_dataset(spark, str(p))


def test_mentions(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"text": "ho khan", "label": [[0, 2, "SYMPTOM"], [1]]}\nno\n')
    good, bad = datasets.mention_lines(spark, str(tmp_path / "m.jsonl"))
    assert [tuple(x) for x in good.first()["label"]] == [(0, 2, "SYMPTOM")] and bad.count() == 1


def test_ontology(spark, tmp_path):
    item = lambda m, code, name: {"vn_mention": m, "selected_concept": {"code": code, "name_vi": name, "group_vi": "g"}}
    (tmp_path / "o.json").write_text(json.dumps({"verified": [item(" b ", "I10", "B")], "review": [item("a", "I10", "C"), item("x", None, "Y"), item("z", "J18", " ")]}, indent=1))
    got = {r["code"]: r for r in datasets.load_ontology(spark, str(tmp_path / "o.json"), "ICD10").collect()}
    assert set(got) == {"I10", "J18"} and got["I10"]["name"] == "B" and got["I10"]["aliases"] == ["B", "C", "a", "b"] and got["J18"]["name"] == "J18"


def test_rxnorm(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps([{"rxcui": "1", "name": "Aspirin"}, {"rxcui": "1", "name": "ASPIRIN"}, {"rxcui": "2", "name": "none"}]))
    (tmp_path / "df.json").write_text(json.dumps({"data": [{"RXCUI": "3", "str": "Tablet", "TTY": "DF"}]}))
    got = sorted((r["concept_id"], r["name"], r["tty"]) for r in datasets.load_rxnorm(spark, {"IN": str(tmp_path / "in.json"), "DF": str(tmp_path / "df.json")}).collect())
    assert got == [("1", "ASPIRIN", "IN"), ("3", "Tablet", "DF")]


def test_catalogs(spark, tmp_path):
    df = spark.createDataFrame([("a", "ho")], "surface_id string, text string")
    assert datasets.write_catalogs({"symptom_surfaces": df}, str(tmp_path)).first()["n"] == 1
    got = datasets.load_catalogs(spark, str(tmp_path))
    assert got["symptom_surfaces"].first()["text"] == "ho" and got["drug_surfaces"].count() == 0


def test_settings():
    env = {"WRITER_URL": "http://x", "WRITER_MODEL": "m", "WRITER_MAX_TOKENS": "5"}
    assert datasets.WriterConfig.from_env(env=env).max_tokens == 5
    for bad in ({}, {**env, "WRITER_TIMEOUT": "x"}, {**env, "WRITER_TOP_P": "2"}):
        with pytest.raises(ValueError):
            datasets.WriterConfig.from_env(env=bad)
