"""Command line: python -m lexmill COMMAND --input PATHS --output PATH [options]. Paths are read by suffix and joined by + or commas; the
output is Parquet unless it ends in .jsonl or .txt. On a cluster run it by spark-submit; locally it makes its own session."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import word_count
from lexmill.operators import chunking, dedup, filters, model_output, projection, quality, sampling, stats
from lexmill.sources import readers, sinks

Command = Callable[[SparkSession, argparse.Namespace], DataFrame]
COMMANDS: dict[str, tuple[Command, str]] = {}


def command(name: str, about: str):
    def add(f: Command) -> Command:
        COMMANDS[name] = (f, about)
        return f

    return add


def _input(spark: SparkSession, a: argparse.Namespace, tag: bool = False) -> DataFrame:
    return readers.scan_many(spark, a.input, tag)


@command("convert", "read the inputs and write them in the output's format")
def convert(spark, a):
    return _input(spark, a)


@command("mix", "at most --n rows, of each input at most twice its even share")
def mix(spark, a):
    return sampling.capped_sample(_input(spark, a, tag=True), "subset", a.n, a.key, a.seed)


@command("sample", "exactly --n rows")
def sample(spark, a):
    return sampling.exact_sample(_input(spark, a), a.n, a.key, a.seed)


@command("shuffle", "all rows in an order fixed by the seed")
def shuffle(spark, a):
    return sampling.shuffled(_input(spark, a), a.key, a.seed)


@command("split", "cut texts to chunks of at most --n words")
def split(spark, a):
    return chunking.split_documents(_input(spark, a), a.n, text=a.text)


@command("filter", "rows that pass the knobs named in --mode, sides apart by _plus_rewritten")
def filter_(spark, a):
    return _input(spark, a).where(filters.by_sides(a.mode, a.by) if "_plus_rewritten" in a.mode else filters.by_mode(a.mode))


@command("thresholds", "rows over the usual thresholds of score, density and classes")
def thresholds(spark, a):
    return _input(spark, a).where(filters.thresholds())


@command("dedup", "one row of each text")
def exact(spark, a):
    return dedup.exact(_input(spark, a), a.text, a.key, a.seed)


@command("near-dedup", "one row of each cluster of similar texts")
def near(spark, a):
    df = _input(spark, a)
    return dedup.keep_one(df, a.key, dedup.near_duplicates(df, a.key, a.text))


@command("repetition", "add drop_reason by the repetition rules")
def repetition(spark, a):
    return quality.repetition_reason(_input(spark, a), a.text)


@command("language", "rows in the languages of --mode, separated by commas")
def language(spark, a):
    return quality.language_filter(quality.identify(_input(spark, a), a.text), tuple(a.mode.split(",")))


@command("rewrites", "parse rewriting output in column --by")
def rewrites(spark, a):
    return model_output.rewriting_rows(_input(spark, a), a.by)


@command("dialogues", "take the dialogues out of texts")
def dialogues(spark, a):
    return model_output.dialogue_rows(_input(spark, a), a.text)


@command("flatten", "the fields of struct --by as columns")
def flatten(spark, a):
    return projection.flatten(_input(spark, a), a.by)


@command("stats", "documents, words and their shares by column --by")
def class_stats(spark, a):
    return stats.by_class(_input(spark, a).withColumn("n_words", word_count(F.col(a.text)).cast("long")), a.by, "n_words", ["n_words"])


@command("counts", "rows by value of column --by")
def counts(spark, a):
    return stats.value_counts(_input(spark, a), a.by)


def write(df: DataFrame, path: str, rows: int | None = None) -> None:
    if path.endswith(".jsonl"):
        sinks.write_jsonl(df, path)
    elif path.endswith(".txt"):
        sinks.write_text(df, path)
    elif rows:
        sinks.write_shards(df, path, rows)
    else:
        df.write.mode("overwrite").parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="lexmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, (_, about) in COMMANDS.items():
        c = sub.add_parser(name, help=about, description=about)
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--text", default="text")
        c.add_argument("--key", default="row_id")
        c.add_argument("--by", default="name")
        c.add_argument("--mode", default="")
        c.add_argument("--n", type=int, default=1000)
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--rows-per-file", type=int)
    a = p.parse_args(argv)
    if spark is None:
        from lexmill.session import local_session

        spark = SparkSession.getActiveSession() or local_session()
    write(COMMANDS[a.command][0](spark, a), a.output, a.rows_per_file)


if __name__ == "__main__":
    main()
