"""The command line over small files."""

import pytest

from lexmill.__main__ import COMMANDS, main


@pytest.fixture
def data(spark, tmp_path):
    rows = [(i, f"le chat {i % 7} est dans la maison et il ne dort pas", "A" if i % 3 else "B") for i in range(40)]
    spark.createDataFrame(rows, "row_id long, text string, name string").write.parquet(str(tmp_path / "in.parquet"))
    return tmp_path


def test_commands(spark, data):
    out = str(data / "out")

    def run(name, *more, path=out):
        main([name, "--input", str(data / "in.parquet"), "--output", path, *more], spark)
        return spark.read.parquet(path) if path == out else None

    assert run("convert").count() == 40 and run("sample", "--n", "7").count() == 7 and run("shuffle").count() == 40
    assert run("mix", "--n", "10").count() == 10 and run("dedup").count() == 7 and run("near-dedup").count() == 7
    assert run("split", "--n", "4").count() == 120 and run("repetition").where("drop_reason is null").count() == 40
    assert run("language", "--mode", "fr,en").count() == 40 and run("counts").count() == 2 and run("stats").count() == 2
    assert run("dialogues").columns[-1] == "raw_text"
    run("convert", path=str(data / "x.jsonl"))
    run("convert", path=str(data / "x.txt"))
    assert spark.read.json(str(data / "x.jsonl")).count() == spark.read.text(str(data / "x.txt")).count() == 40
    run("convert", "--rows-per-file", "10")
    assert spark.read.parquet(out).count() == 40 and len(COMMANDS) >= 16
    with pytest.raises(SystemExit):
        main(["nothing"], spark)
