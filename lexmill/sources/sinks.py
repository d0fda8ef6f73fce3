"""Sinks: text, JSON lines, sharded and partitioned Parquet, resumable batches, training shards with an index."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut_lineage


def write_text(df: DataFrame, path: str, shards: int | None = None) -> None:
    """One document per line end; line ends inside documents stay. shards spreads rows round robin."""
    out = df.select(F.coalesce("text", F.lit("")).alias("value"))
    (out.repartition(shards) if shards else out).write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """UTF-8 lines; null fields are left out at every depth unless keep_nulls (nulls in lists always stay)."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_shards(df: DataFrame, path: str, rows: int) -> None:
    """Parquet files of at most `rows` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def write_single(df: DataFrame, path: str) -> None:
    """One Parquet file, written by one task; for results that are small."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def slug(label):
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def write_by_label(df: DataFrame, label: str, path: str, rows: int = 1_000_000) -> None:
    """A directory per label slug in one pass; null labels go to Spark's default partition."""
    df.withColumn("label_slug", slug(F.col(label))).write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy("label_slug").parquet(path)


def write_reasons(df: DataFrame, reason: str, kept: str, dropped: str) -> None:
    """Rows without a reason to `kept`, the others to `dropped`, a directory per reason. df is computed once, in the shared folder."""
    held = cut_lineage(df)
    held.where(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(kept)
    held.where(F.col(reason).isNotNull()).write.mode("overwrite").partitionBy(reason).json(dropped)


def done_batches(spark, path: str) -> DataFrame:
    """batch: the batches already written under path."""
    try:
        return spark.read.parquet(f"{path}/_manifest").select("batch").distinct()
    except Exception as e:  # no manifest yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "batch int")


def write_batches(df: DataFrame, key: str, batches: int, path: str, run=lambda x: x) -> int:
    """Rows in `batches` hash batches, each run and written once; a second call does only what a broken one left. Returns how many. The rows
    left are written aside by batch first, so that a batch reads its own rows and not the whole input again."""
    spark = df.sparkSession
    done = [r.batch for r in done_batches(spark, path).collect()]  # numbers under `batches`
    if len(done) == batches:
        return 0
    tagged = df.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(batches)).cast("int"))
    aside = f"{path}/_aside"
    tagged.where(~F.col("batch").isin(done) if done else F.lit(True)).write.mode("overwrite").partitionBy("batch").parquet(aside)
    held = spark.read.schema(tagged.schema).parquet(aside)
    todo = sorted(set(range(batches)) - set(done))
    for b in todo:
        run(held.where(F.col("batch") == b)).write.mode("overwrite").parquet(f"{path}/batch={b}")
        spark.createDataFrame([(b,)], "batch int").coalesce(1).write.mode("append").parquet(f"{path}/_manifest")
    return len(todo)


def exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_training_shards(df: DataFrame, path: str, split: str = "split", rows: int = 100_000, mb: int = 512) -> dict:
    """Shards of JSON lines of column text per split, each of at most `rows` rows and about `mb` MB of text, and an index of splits and
    their files with rows and bytes. The index is written last and marks a complete set: where it exists nothing is done, where it doesn't
    what a broken run left is overwritten. Returns the index. Null text is empty text."""
    spark = df.sparkSession
    if exists(spark, f"{path}/_index"):
        return json.loads(spark.read.text(f"{path}/_index").first()[0])
    lean = df.select(F.coalesce("text", F.lit("")).alias("text"), F.col(split).alias("split"))
    mean = lean.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    most = max(1, min(rows, int(mb * 2**20 / max(mean, 1.0))))
    lean.write.mode("overwrite").option("maxRecordsPerFile", most).partitionBy("split").json(path)
    files = spark.read.schema("text string, split string").json(path).groupBy("split", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    index: dict = {}
    for r in files.orderBy("split", "file").toLocalIterator():  # a row per file
        index.setdefault(r.split, []).append({"file": r.file.rsplit("/", 1)[-1], "rows": r.rows, "bytes": r.bytes})
    out = {k: {"rows": sum(f["rows"] for f in v), "files": len(v), "shards": v} for k, v in index.items()}
    spark.createDataFrame([(json.dumps(out, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_index")
    return out


def write_summary(counts: DataFrame, name: str, file: str, path: str) -> None:
    """The rows of rollup_counts as JSON lines: those of files, then the totals of names, then the total, whose name is 'total' and whose
    file, as that of the names, is -1."""
    label = F.when(F.col("level") == 2, F.lit("total")).otherwise(F.col(name))
    number = F.when(F.col("level") == 0, F.col(file)).otherwise(F.lit(-1))
    rows = counts.select("level", label.alias("name"), number.alias("parquet_idx"), "n_docs", "n_words")
    rows.orderBy("level", "name", "parquet_idx").drop("level").coalesce(1).write.mode("overwrite").json(path)


def write_marked(df: DataFrame, path: str) -> bool:
    """df as Parquet unless a complete set is there already; says whether it was written. Spark's success file is the mark, so a broken
    run is written again."""
    if exists(df.sparkSession, f"{path}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_report(df: DataFrame, path: str, limit: int = 10_000) -> str:
    """A report of at most limit rows as one CSV file; returns it as a Markdown table. Larger results are refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report has at most {limit} rows")
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(df.columns), line("-" for _ in df.columns), *map(line, rows)])
