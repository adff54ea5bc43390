"""Fine-tuning hook, synthetic cases with an injected writer, and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from notara import cli
from notara.operators import synth, training
from notara.schemas import DIAGNOSIS, DRUG, SYMPTOM


class Model:
    class P:
        def numel(self):
            return 100

    def parameters(self):
        return [self.P()]

    def train_model(self, train_dataset, eval_dataset, **kwargs):
        assert [x["tokenized_text"] for x in train_dataset][0] == train_dataset[0]["tokenized_text"] and len(train_dataset) == len(list(train_dataset))


def make(name):
    return Model()


def samples(spark, end=0):
    return spark.createDataFrame([(["a"], [(0, end, "X")])] * 3, "tokenized_text array<string>, ner array<struct<start:int,end:int,label:string>>")


def test_fine_tune(spark, tmp_path):
    got = training.fine_tune(samples(spark), samples(spark).limit(1), training.TrainerConfig(output_dir=str(tmp_path)), lambda name: Model())
    assert got == {"parameter_count": 100, "train": 3, "eval": 1} and json.loads((tmp_path / "manifest.json").read_text())["result"] == got
    with pytest.raises(ValueError, match="bad_span"):
        training.fine_tune(samples(spark, 1), samples(spark), training.TrainerConfig(output_dir=str(tmp_path)), lambda name: Model())
    with pytest.raises(ValueError):
        training.TrainerConfig(fp16=True, bf16=True)


@pytest.fixture(scope="module")
def pool(spark):
    rows = [(f"{k}{i}", kind, [c]) for k, kind, c in (("đau ", SYMPTOM, ""), ("bệnh ", DIAGNOSIS, "I10"), ("thuốc ", DRUG, "7")) for i in range(30)]
    return spark.createDataFrame(rows, "text string, entity_type string, candidates array<string>")


def test_writer_repairs_then_falls_back(spark, pool):
    specs = synth.generate_cases(spark, 3, 1, pool)
    assert sorted(specs.collect()) == sorted(synth.generate_cases(spark, 3, 1, pool).repartition(2).collect())
    good = synth.render_cases(specs, lambda p: p.split("Bản mẫu:\n")[1].split("\nSửa")[0])
    assert {s["render_mode"] for r in good.collect() for s in r["sections"]} == {"llm"}
    bad = synth.render_cases(specs, lambda p: "no placeholders")
    assert {(s["render_mode"], s["attempt"]) for r in bad.collect() for s in r["sections"]} == {("template_fallback", 3)}
    assert synth.validate_cases(specs, bad).where(F.size("errors") > 0).count() == 0
    broken = bad.withColumn("marked_text", F.replace("marked_text", F.lit("[[E0]]"), F.lit("")))
    assert synth.validate_cases(specs, broken).where(F.size("errors") > 0).count() == 3


def test_command_line(spark, tmp_path, pool):
    (tmp_path / "in").mkdir()
    for i in (10, 2):
        (tmp_path / "in" / f"{i}.txt").write_text("ho")
    assert cli.main(["infer", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "o.zip")]) == 1
    (tmp_path / "d.jsonl").write_text("".join(json.dumps({"note_id": str(i), "text": "ho khan", "entities": [{"text": "ho", "type": SYMPTOM, "position": [0, 2], "assertions": [], "candidates": []}]}) + "\n" for i in range(6)))
    assert cli.main(["prepare", "--documents", str(tmp_path / "d.jsonl"), "--output", str(tmp_path / "s"), "--errors", str(tmp_path / "e"), "--ratio", "0.25"]) == 0
    assert spark.read.json(str(tmp_path / "s")).groupBy("split").count().count() == 2
    pool.write.parquet(str(tmp_path / "pool"))
    assert cli.main(["generate", "--surfaces", str(tmp_path / "pool"), "--output", str(tmp_path / "n"), "--errors", str(tmp_path / "ge"), "--num-samples", "5"]) == 0
    assert spark.read.json(str(tmp_path / "n")).count() == 5
    again = ["generate", "--surfaces", str(tmp_path / "pool"), "--output", str(tmp_path / "n"), "--errors", str(tmp_path / "ge"), "--resume", "--num-samples", "7"]
    assert cli.main(again) == 0 and spark.read.json(str(tmp_path / "n")).select("case_id").distinct().count() == 7 == spark.read.json(str(tmp_path / "n")).count()
    check = ["validate", "--specs", str(tmp_path / "n-specs"), "--notes", str(tmp_path / "n"), "--output", str(tmp_path / "ok"), "--rejected", str(tmp_path / "no")]
    assert cli.main(check) == 0 and spark.read.json(str(tmp_path / "ok")).count() == 7
    (tmp_path / "p.jsonl").write_text('{"note_id": "1", "entities": []}\n')
    assert cli.main(["package", "--predictions", str(tmp_path / "p.jsonl"), "--output", str(tmp_path / "p.zip")]) == 0
    (tmp_path / "c.jsonl").write_text("".join(json.dumps({"note_id": str(i), "text": "ho khan"}) + "\n" for i in range(6)))
    pairs = ["--documents", str(tmp_path / "c.jsonl"), "--labels", str(tmp_path / "d.jsonl"), "--errors", str(tmp_path / "e2")]
    assert cli.main(["train", "--model", "m", "--factory", "tests.test_training:make", "--output", str(tmp_path / "m"), *pairs]) == 0
    assert json.loads((tmp_path / "m" / "manifest.json").read_text())["result"]["eval"] == 1
    assert cli.main(["train", "--model", "m", "--dry-run", *pairs]) == 0
    (tmp_path / "c.jsonl").write_text('{"note_id": "1", "text": "ho khan"}\n')
    with pytest.raises(ValueError, match="missing contents"):
        cli.main(["prepare", *pairs])
