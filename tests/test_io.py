import zipfile

import pytest

from lexmill.sources import readers, sinks
from lexmill.streaming import files


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "aé", None), (2, "b", "u")], "id int, text string, url string")
    df.write.parquet(str(tmp_path / "p"))
    sinks.write_jsonl(df, str(tmp_path / "x.jsonl"))
    df.write.csv(str(tmp_path / "x.csv"), header=True)
    df.write.orc(str(tmp_path / "x.orc"))
    sinks.write_text(df, str(tmp_path / "x.txt"), shards=2)
    for p in ("p", "x.jsonl", "x.csv", "x.orc", "x.txt"):
        assert readers.scan(spark, str(tmp_path / p)).count() == 2
    lines = "".join(p.read_text() for p in (tmp_path / "x.jsonl").glob("part*")).splitlines()
    assert sum("url" in x for x in lines) == 1 and any("aé" in x for x in lines)
    both = readers.scan_many(spark, f"{tmp_path}/p+{tmp_path}/x.txt", tag=True)
    assert both.count() == 4 and both.where("id is null").count() == 2
    with pytest.raises(ValueError):
        readers.scan(spark, "x.unknown")


def test_nested_zip_and_lines(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    spark.range(3).write.parquet(str(tmp_path / "d" / "e" / "q"))
    assert readers.scan(spark, str(tmp_path / "d"), recursive=True).count() == 3
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("b.txt", "two")
        z.writestr("a.txt", "one")
        z.writestr("c.bin", "no")
    assert [r.text for r in readers.scan(spark, str(tmp_path / "z.zip")).collect()] == ["one", "two"]
    (tmp_path / "l.txt").write_text("a\n\n  b \nc\n")
    assert [(r.line, r.text) for r in readers.lines(spark, str(tmp_path / "l.txt"), skip=1, limit=1).collect()] == [(2, "b")]


def test_partitioned_and_resumed(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "if(id % 2 = 0, 'Big Label', 'b') as label", "if(id < 5, 'short', null) as reason", "if(id < 90, 'train', 'validation') as split", "'t' as text")
    sinks.write_by_label(df, "label", str(tmp_path / "l"))
    assert (tmp_path / "l" / "label_slug=big_label").exists()
    sinks.write_reasons(df, "reason", str(tmp_path / "k"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 95
    assert sinks.write_batches(df, "id", 4, str(tmp_path / "b")) == 4
    assert sinks.write_batches(df, "id", 4, str(tmp_path / "b")) == 0
    assert sinks.write_training_shards(df, str(tmp_path / "t"), rows=50)["train"]["rows"] == 90
    sinks.write_shards(df.coalesce(1), str(tmp_path / "s"), 30)
    assert len(list((tmp_path / "s").glob("part*"))) == 4


def test_stream_takes_each_file_once(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(5).write.parquet(src)
    run = lambda: files.process_new_files(spark, src, "id long", str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    run()
    spark.range(5, 8).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8


def test_first_deliveries_of_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = lambda *xs: spark.createDataFrame([(k, t) for k, t in xs], "k long, t string").selectExpr("k", "to_timestamp(t) as at")
    run = lambda: files.process_new_files(spark, src, "k long, at timestamp", str(tmp_path / "out"), str(tmp_path / "cp"), lambda s: files.first_deliveries(s, "k", "at"))
    rows((1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-03")).write.parquet(src)
    run()
    rows((1, "2024-01-05"), (3, "2024-01-06")).write.mode("append").parquet(src)
    run()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
