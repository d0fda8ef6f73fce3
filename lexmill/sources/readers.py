"""Readers, chosen by suffix. Schemas may be given; else they are inferred once."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.json import strict
from lexmill.functions.text import strip
from lexmill.session import cut_lineage


def scan(spark: SparkSession, path: str, schema=None, recursive: bool = False) -> DataFrame:
    """One path: .txt (a row per line, column text), .json/.jsonl, .csv/.csv.gz, .parquet, .orc, .zip of .txt, or a directory of files of
    one of these kinds, read flat or, if recursive, with all directories below. Other suffixes are refused."""
    name = path.rstrip("/").lower()
    r = spark.read.schema(schema) if schema is not None else spark.read
    if "." not in name.rsplit("/", 1)[-1]:
        name = directory_suffix(spark, path, recursive)
        r = r.option("recursiveFileLookup", recursive).option("pathGlobFilter", f"*{name}")
    if re.search(r"\.txt(\.gz|\.zst)?$", name):
        return r.format("text").load(path).withColumnRenamed("value", "text")
    if re.search(r"\.jsonl?(\.gz)?$", name):
        return r.option("multiLine", not json_lines(spark, path)).json(path)
    if re.search(r"\.csv(\.gz)?$", name):
        return r.csv(path, header=True, multiLine=True, escape='"', inferSchema=schema is None)
    if name.endswith(".orc"):
        return r.orc(path)
    if name.endswith(".zip"):
        return zip_texts(spark, path)
    if name.endswith(".parquet"):
        return r.parquet(path)
    raise ValueError(f"unknown format: {path}")


def json_lines(spark: SparkSession, path: str) -> bool:
    """Whether the file holds one object a line: its first line that is not blank is a whole object. An array, or an object over several
    lines, is one document. An empty file counts as lines."""
    head = spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "").limit(1).select(F.ltrim("value").startswith("{") & strict(F.col("value")).isNotNull()).collect()
    return not head or bool(head[0][0])


def scan_many(spark: SparkSession, paths: str, tag: bool = False, adapt: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Paths joined by + or commas: UNION ALL by name with missing columns null; with tag, the path as column subset. adapt turns the rows
    of each path into the wanted ones first."""
    parts = [p.strip() for p in re.split(r"[+,]", paths) if p.strip()]
    frames = [f.withColumn("subset", F.lit(p)) if tag else f for p in parts for f in (adapt(scan(spark, p)),)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def zip_texts(spark: SparkSession, path: str) -> DataFrame:
    """member, text: a row per .txt member of each archive; undecodable bytes are replaced."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for n in sorted(z.namelist()):
                        if n.endswith(".txt"):
                            yield pa.RecordBatch.from_pydict({"member": [n], "text": [z.read(n).decode("utf-8", "replace")]})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(members, "member string, text string")


def lines(spark: SparkSession, path: str, skip: int = 0, limit: int | None = None) -> DataFrame:
    """file, line (number in the file, from 0, before blank lines are dropped), text stripped; blank lines are left out. skip counts all
    lines of each file, limit those that are left. A file may be read in many blocks: lines are numbered inside their block, in the order
    of reading, and moved by the sizes of the blocks before it."""
    block = ["file", "block"]
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), strip(F.col("value")).alias("text"))
    held = cut_lineage(read)
    sizes = held.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))  # a row a block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(*block).orderBy("at")) - 1
    rows = held.withColumn("place", place).join(starts, block).select("file", (F.col("start") + F.col("place")).alias("line"), "text")
    rows = rows.where((F.col("text") != "") & (F.col("line") >= skip))
    if limit is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("line"))).where(F.col("_n") <= limit).drop("_n")
    return rows


def directory_suffix(spark: SparkSession, path: str, recursive: bool = False) -> str:
    """The one suffix of the files under a directory, from their names alone; several are an error, none is Parquet."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    names = files.select(F.regexp_extract("path", r"(\.(?:txt|jsonl?|csv|parquet|orc|zip)(?:\.(?:gz|zst))?)$", 1).alias("s"))
    found = sorted(r.s for r in names.where("s <> ''").distinct().collect())  # a few suffixes
    if len(found) > 1:
        raise ValueError(f"several formats under {path}: {found}")
    return found[0] if found else ".parquet"
