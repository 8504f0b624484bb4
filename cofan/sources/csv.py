"""CSV readers for the ratings / movies snapshot directory.

A table is one file or a folder of shards.  Columns bind by header name: the read schema
follows the header's order (contract types for contract columns, string for extras)
and contract order is selected.  An explicit schema alone binds by position, so a file
with reordered columns would silently load into the wrong fields.  The first file's
header stands for the table, and a file with another one fails the read; with
``mixed`` files are read per distinct header, which takes one pass more over the text.  RFC-4180 doubled quotes are unescaped
(``escape='"'``); malformed cells become NULL (PERMISSIVE), and ``with_lineage`` keeps
the raw record and its file.  ``multiLine`` stays off so large files are split across
tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cofan.operators.quality import require_columns
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA
from cofan.sources import files

FILES = {"ratings": ("ratings.csv", RATINGS_SCHEMA), "movies": ("movies.csv", MOVIES_SCHEMA)}
CORRUPT, FILE = "_corrupt_record", "_file"


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file's first record (BOM stripped; [] for an empty file)."""
    return _reader(spark).option("inferSchema", False).csv(path).columns


def _layouts(spark: SparkSession, path: str, mixed: bool) -> list[tuple[list[str], list[str]]]:
    """(header, files) for each header to read the table at ``path`` by."""
    if not mixed:
        return [(read_header(spark, path), [path])]
    found = files.headers(spark, path, (path.rstrip("/").rpartition("/")[2],))
    rows = found.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return sorted((list(r["columns"]), list(r["paths"])) for r in rows) or [([], [path])]


def read_contract_csv(spark: SparkSession, path: str, schema: StructType, keep_extra: bool = False,
                      name: str | None = None, lineage: bool = False, mixed: bool = False) -> DataFrame:
    """Read one CSV table with contract types, binding columns by header name; with
    ``lineage`` also the raw text of records that do not fit, and their file; with
    ``mixed`` each file by its own header."""
    by_name = {f.name: f for f in schema.fields}
    parts = []
    for header, paths in _layouts(spark, path, mixed):
        require_columns(name or path.rstrip("/").rpartition("/")[2], schema.fieldNames(), header)
        own = [StructField(c, by_name[c].dataType, True) if c in by_name else StructField(c, StringType(), True) for c in header]
        reader = _reader(spark).option("enforceSchema", False).option("recursiveFileLookup", True)
        cols = schema.fieldNames() + ([c for c in header if c not in by_name] if keep_extra else [])
        if lineage:
            own.append(StructField(CORRUPT, StringType(), True))
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        df = reader.schema(StructType(own)).csv(paths)
        parts.append(df.select(*cols, *([CORRUPT, F.col("_metadata.file_path").alias(FILE)] if lineage else [])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=keep_extra), parts)


def with_lineage(spark: SparkSession, path: str, schema: StructType, mixed: bool = False) -> DataFrame:
    """The contract columns, ``_corrupt_record`` (NULL for a record that fits) and
    ``_file`` of every record."""
    return read_contract_csv(spark, path, schema, lineage=True, mixed=mixed)


def load(spark: SparkSession, data_path: str, mixed: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(ratings, movies)`` from ``<data_path>/ratings.csv`` and ``movies.csv``."""
    out = []
    for key in ("ratings", "movies"):
        fname, schema = FILES[key]
        out.append(read_contract_csv(spark, files.join(data_path, fname), schema, name=fname, mixed=mixed))
    return out[0], out[1]


def load_movies(spark: SparkSession, data_path: str) -> DataFrame:
    fname, schema = FILES["movies"]
    return read_contract_csv(spark, files.join(data_path, fname), schema, name=fname)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Exploratory read with type inference (one extra pass over the file)."""
    return _reader(spark).option("inferSchema", True).csv(path)


def read_as_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as string, for type checks over the full data."""
    return _reader(spark).option("inferSchema", False).csv(path)
