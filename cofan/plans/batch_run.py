"""End-to-end batch run: input checks, processed zone and report, sample
recommendations, and an appended run record (success or failure).

Every stage is a function of its own that can be run alone and returns a ``Stage``:
what it counted and what it wrote.  ``run`` chains them and derives the record from the
stages that finished.  Paths are joined as text, so they may be URLs of a shared store,
and a table may be one CSV file or a folder of shards.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofan.operators import aggregates as A
from cofan.operators import corating
from cofan.sources import csv as csv_source
from cofan.sources import files, sinks
from cofan.sources import parquet as parquet_source

# Folders below the output path.
ZONE, TOP, RECOMMENDED, RECORDS = "processed", "top_movies", "sample_recommendations", "run_metadata"


@dataclass
class Stage:
    """What one stage did: rows per table, written folders, and facts of its own."""

    name: str
    rows: dict[str, int] = field(default_factory=dict)
    written: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)


def check(spark: SparkSession, data_path: str) -> Stage:
    """The tables' files exist and hold bytes, and every file's header has the
    required columns."""
    found = files.sizes(spark, data_path)
    return Stage("check", facts={"bytes": found, "headers": files.check_headers(spark, data_path)})


def process(spark: SparkSession, data_path: str, output_path: str, top_n: int = 100, mixed: bool = False) -> Stage:
    """Parse the CSV (with ``mixed`` each file by its own header) once into a Parquet zone, which cuts lineage (a lost executor
    never parses CSV again), count its tables, and write the top movies."""
    zone, top = files.join(output_path, ZONE), files.join(output_path, TOP)
    for name, table in zip(("ratings", "movies"), csv_source.load(spark, data_path, mixed)):
        sinks.write_parquet(table, files.join(zone, name))
    ratings, movies = parquet_source.load(spark, zone)
    rows = {r["table_name"]: r["row_count"] for r in A.row_counts(ratings, movies).collect()}
    sinks.write_csv(A.top_movies(ratings, movies, top_n), top, single_file=True)  # at most top_n rows
    return Stage("process", rows | {"processed_top_movies": _csv_rows(spark, top)}, {"top_movies": top, "processed": zone})


def recommend(spark: SparkSession, output_path: str, movie_title: str, top_n: int = 10) -> Stage:
    """Write the recommendations for one title from the processed zone."""
    ratings, movies = parquet_source.load(spark, files.join(output_path, ZONE))
    out = files.join(output_path, RECOMMENDED)
    sinks.write_csv(corating.recommend_similar(ratings, movies, movie_title, top_n=top_n), out, single_file=True)  # at most top_n rows
    return Stage("recommend", {"sample_recommendations": _csv_rows(spark, out)}, {"sample_recommendations": out}, {"movie_title": movie_title})


def run(spark: SparkSession, data_path: str, output_path: str, movie_title: str = "Toy Story",
        top_n: int = 10, processed_top_n: int = 100) -> dict:
    """All stages with the caller's session (which is not stopped), then one record
    appended to ``run_metadata/``.  When a stage fails the record says so, with what the
    stages before it did, and the error is raised again."""
    began, done = _now(), []
    try:
        done.append(check(spark, data_path))
        mixed = any(len(h) > 1 for h in done[0].facts["headers"].values())
        done.append(process(spark, data_path, output_path, processed_top_n, mixed))
        done.append(recommend(spark, output_path, movie_title, top_n))
    except Exception as error:
        _append(spark, output_path, summary(data_path, began, done, error))
        raise
    record = summary(data_path, began, done)
    _append(spark, output_path, record)
    return record


def summary(data_path: str, began: str, done: list[Stage], error: Exception | None = None) -> dict:
    """A run record: the union of what the finished stages counted and wrote."""
    out = {
        "status": "failed" if error else "success", "started_at": began, "input_path": data_path,
        "stages": [s.name for s in done], "row_counts": {}, "outputs": {}, "facts": {},
    }
    for stage in done:
        out["row_counts"] |= stage.rows
        out["outputs"] |= stage.written
        out["facts"][stage.name] = stage.facts
    return out | ({"error": {"type": type(error).__name__, "message": str(error)}} if error else {})


def read_run_records(spark: SparkSession, output_path: str) -> DataFrame:
    """All appended run records, newest first."""
    return spark.read.json(files.join(output_path, RECORDS)).orderBy(F.col("completed_at").desc())


def _append(spark: SparkSession, output_path: str, record: dict) -> None:
    sinks.append_run_record(spark, record, files.join(output_path, RECORDS))


def _csv_rows(spark: SparkSession, path: str) -> int:
    return spark.read.option("header", True).csv(path).count()


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()
