"""File-level checks of a snapshot folder: which files there are, what their headers
say, and what the tables hold.

A snapshot's tables are CSV files or folders of CSV shards below one path, which may
be any path that Spark reads.  Checks are frames with a row a file, built by Spark's
readers; only their summary reaches the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofan.schemas import REQUIRED_COLUMNS

NAMES = tuple(REQUIRED_COLUMNS)


def join(base: str, *parts: str) -> str:
    """``base`` and ``parts`` as one path; ``base`` may be a URL."""
    return "/".join([base.rstrip("/"), *parts])


def _table_of(path: Column, names: tuple[str, ...]) -> Column:
    """Which of ``names`` a file is, or is a shard of (any depth); NULL for others."""
    at = [F.when(path.endswith("/" + n) | path.contains(f"/{n}/"), F.lit(n)) for n in names]
    return F.coalesce(*at)


def listing(spark: SparkSession, data_path: str, names: tuple[str, ...] | None = None) -> DataFrame:
    """``(file_name, path, length, modificationTime)`` of every file below
    ``data_path``, shards too; with ``names`` only the files of those tables, and
    their ``table_name``.  Empty files have no row; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(data_path)
    files = found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length", "modificationTime")
    if names is None:
        return files
    return files.select(_table_of(F.col("path"), names).alias("table_name"), "*").filter("table_name IS NOT NULL")


def fingerprint(spark: SparkSession, data_path: str, names: tuple[str, ...] = NAMES) -> DataFrame:
    """``(file_name, length, modificationTime)`` of the snapshot's files: a cheap cache
    key.  ``content_fingerprint`` reads the rows."""
    return listing(spark, data_path, names).select("file_name", "length", "modificationTime")


def content_fingerprint(df: DataFrame, table_name: str) -> DataFrame:
    """``(table_name, row_count, hash_a, hash_b)``: sums of two 32-bit words of each
    row's MD5.  Neither row order nor partitions matter, repeated rows count, and a
    row's text holds every cell with its length, so that any changed cell changes it."""
    cell = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    text = F.concat(*[cell(F.col(f"`{c}`").cast("string")) for c in df.columns])
    word = lambda k: F.conv(F.substring("_md5", 1 + 8 * k, 8), 16, 10).cast("bigint")
    return df.select(F.md5(text.cast("binary")).alias("_md5")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(word(0)), F.lit(0)).alias("hash_a"), F.coalesce(F.sum(word(1)), F.lit(0)).alias("hash_b"),
    ).select(F.lit(table_name).alias("table_name"), "*")


def sizes(spark: SparkSession, data_path: str, names: tuple[str, ...] = NAMES) -> dict[str, int]:
    """Bytes of each table of a snapshot.  ``FileNotFoundError`` names the tables
    without a file, ``ValueError`` those whose files are all empty."""
    try:
        files = listing(spark, data_path, names)
        # Empty files are in the plan's file list only.
        there = {n for p in files.inputFiles() for n in names if p.endswith("/" + n) or f"/{n}/" in p}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        there = set()
    if absent := [n for n in names if n not in there]:
        raise FileNotFoundError(f"no file for {', '.join(absent)} below {data_path}")
    got = {r["table_name"]: int(r["n"]) for r in files.groupBy("table_name").agg(F.sum("length").alias("n")).collect()}
    if empty := [n for n in names if not got.get(n)]:
        raise ValueError(f"only empty files for {', '.join(empty)} below {data_path}")
    return got


def headers(spark: SparkSession, data_path: str, names: tuple[str, ...] = NAMES) -> DataFrame:
    """``(table_name, path, columns array<string>)``: the first record of every file,
    unquoted and without a byte order mark.  One pass over the files as text; a
    partition keeps one line a file, so little is shuffled."""
    lines = spark.read.option("recursiveFileLookup", True).text(data_path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    own = lines.select(_table_of(F.col("path"), names).alias("table_name"), "*").filter("table_name IS NOT NULL AND block = 0")
    # Rows of a block come in file order.
    first = own.groupBy("table_name", "path").agg(F.min_by("value", "at").alias("line"))
    cells = F.split(F.regexp_replace("line", "^﻿", ""), ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    plain = F.transform(cells, lambda c: F.replace(F.regexp_replace(c, '^"|"\r?$|\r$', ""), F.lit('""'), F.lit('"')))
    return first.select("table_name", "path", plain.alias("columns"))


def header_report(found: DataFrame, required: dict[str, tuple[str, ...]] = REQUIRED_COLUMNS) -> DataFrame:
    """``(table_name, path, columns, missing)`` for a frame of headers."""
    wanted = F.coalesce(*[F.when(F.col("table_name") == n, F.array(*map(F.lit, c))) for n, c in required.items()])
    return found.select("*", F.array_sort(F.array_except(wanted, "columns")).alias("missing"))


def check_headers(spark: SparkSession, data_path: str, shown: int = 5) -> dict[str, list[list[str]]]:
    """The different headers of each table.  ``ValueError`` names up to ``shown`` files
    that lack required columns, and how many do."""
    report = header_report(headers(spark, data_path))
    bad = report.filter(F.size("missing") > 0)
    worst = bad.orderBy("path").limit(shown).collect()
    if worst:
        said = "; ".join(f"{r['path']} lacks {', '.join(r['missing'])}" for r in worst)
        raise ValueError(f"{bad.count()} files with incomplete headers: {said}")
    out: dict[str, list[list[str]]] = {}
    for r in report.select("table_name", "columns").distinct().collect():
        out.setdefault(r["table_name"], []).append(list(r["columns"]))
    return {n: sorted(x) for n, x in out.items()}


def total_bytes(spark: SparkSession, path: str) -> int:
    """Total byte size of the files under ``path`` (from the listing, one aggregate row)."""
    return int(listing(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])
