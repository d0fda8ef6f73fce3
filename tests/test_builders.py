import pytest
from pyspark.sql import functions as F

from lexmill.operators import builders, prompts
from lexmill.sources import sinks


def test_builders(spark):
    df = spark.createDataFrame([("q ?", "a", "b", ["l", "'", "os", "."]), (None, None, "b", None)], "stem string, c1 string, c2 string, tokens array<string>")
    got = df.select(builders.question("stem", ["c1", "c2"]), builders.token_list("tokens", repair=True), builders.lowered("stem")).collect()
    assert tuple(got[0]) == ("q ? (1) a (2) b", "l'os.", "q ?") and tuple(got[1]) == ("(2) b", None, None)
    with pytest.raises(ValueError):
        builders.build("nowhere", [("x", lambda: F.lit(1))])


def test_augmentation_and_config(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"]), (3, None)], "k int, labels array<string>")
    out = builders.augment_order(df, "labels", "k").collect()
    assert len(out) == 4 and all(sorted(r.labels) == ["a", "b", "c"] for r in out if r.k == 1)
    assert df.select(builders.model_config("m", 0.5, 1.0, 10, genre="g").alias("c")).select("c.genre", "c.max_tokens").first() == ("g", 10)


def test_reports_and_templates(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "name string, n int")
    assert sinks.write_report(df, str(tmp_path / "r")).splitlines() == ["| name | n |", "| - | - |", "| a | 1 |", "| b |  |"]
    with pytest.raises(ValueError):
        sinks.write_report(df, str(tmp_path / "r2"), limit=1)
    (tmp_path / "p.txt").write_text("main")
    (tmp_path / "p_style_note.txt").write_text("note")
    assert prompts.load_template(str(tmp_path / "p.txt")) == ("main", {"note": "note"})
    assert prompts.json_schema({"a": "string"}, "items", 3)["properties"]["items"]["maxItems"] == 3
