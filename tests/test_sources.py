import os

import pytest

from cofan.sources import csv as CSV
from cofan.sources import files
from tests.conftest import write_fixture_csv


def test_fixture_valid(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"))
    assert files.sizes(spark, d) == {n: os.path.getsize(os.path.join(d, n)) for n in ("ratings.csv", "movies.csv")}
    assert files.check_headers(spark, d) == {
        "ratings.csv": [["userId", "movieId", "rating", "timestamp"]], "movies.csv": [["movieId", "title", "genres"]]}
    r, m = CSV.load(spark, d)
    assert (r.count(), m.count()) == (12, 5)
    assert r.schema["userId"].dataType.simpleString() == "int"


def test_missing_files(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    (d / "other.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.sizes(spark, str(d))
    with pytest.raises(FileNotFoundError):
        files.sizes(spark, str(tmp_path / "nope"))


def test_empty_file(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), ratings_text="")
    with pytest.raises(ValueError, match="empty"):
        files.sizes(spark, d)


def test_header_only_passes_existence(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), ratings_text="userId,movieId,rating,timestamp\n")
    files.sizes(spark, d)


def _sharded(spark, ratings, movies, path):
    ratings.repartition(3).write.option("header", True).csv(os.path.join(path, "ratings.csv"))
    movies.select("genres", "title", "movieId").write.option("header", True).csv(os.path.join(path, "movies.csv"))
    return path


def _add_shard(path, table, text):
    with open(os.path.join(path, table, "part-extra.csv"), "w", encoding="utf-8") as f:
        f.write(text)


def test_sharded_snapshot(spark, tmp_path, ratings, movies):
    d = _sharded(spark, ratings, movies, str(tmp_path / "s"))
    assert set(files.sizes(spark, "file://" + d)) == {"ratings.csv", "movies.csv"}
    assert files.headers(spark, d).filter("table_name = 'ratings.csv'").count() == 3
    r, m = CSV.load(spark, "file://" + d)
    assert (r.count(), m.filter("movieId = 1").first()["title"]) == (12, "Toy Story (1995)")


def test_mixed_headers(spark, tmp_path, ratings, movies):
    d = _sharded(spark, ratings, movies, str(tmp_path / "s"))
    _add_shard(d, "ratings.csv", '"timestamp",rating,"user""s",movieId,userId\n7,4.5,x,2,9\n')
    found = files.check_headers(spark, d)["ratings.csv"]
    assert found == [["timestamp", "rating", 'user"s', "movieId", "userId"], ["userId", "movieId", "rating", "timestamp"]]
    with pytest.raises(Exception):  # noqa: B017 - Spark refuses the other header
        CSV.load(spark, d)[0].collect()
    r, _ = CSV.load(spark, d, mixed=True)
    assert r.count() == 13 and tuple(r.filter("userId = 9").first()) == (9, 2, 4.5, 7)
    wide = CSV.read_contract_csv(spark, os.path.join(d, "ratings.csv"), CSV.RATINGS_SCHEMA, keep_extra=True, mixed=True)
    assert {x['user"s'] for x in wide.collect()} == {None, "x"}


def test_incomplete_headers_are_reported_by_file(spark, tmp_path, ratings, movies):
    d = _sharded(spark, ratings, movies, str(tmp_path / "s"))
    _add_shard(d, "ratings.csv", "userId,rating\n1,2.0\n")
    with pytest.raises(ValueError, match="1 files.*part-extra.csv lacks movieId, timestamp"):
        files.check_headers(spark, d)


def test_malformed_records_by_file(spark, tmp_path, ratings, movies):
    from cofan.operators.quality import malformed_records

    d = _sharded(spark, ratings, movies, str(tmp_path / "s"))
    _add_shard(d, "ratings.csv", "userId,movieId,rating,timestamp\n1,x2,4.0,5\n1,2,,5\n1,2,3.0,zz\n")
    rows = CSV.with_lineage(spark, os.path.join(d, "ratings.csv"), CSV.RATINGS_SCHEMA)
    got = {r["file"].rpartition("/")[2]: r for r in malformed_records(rows, "ratings").collect()}
    extra = got.pop("part-extra.csv")
    assert (extra["record_count"], extra["malformed"], extra["example"]) == (3, 2, "1,2,3.0,zz")
    assert sum(r["record_count"] for r in got.values()) == 12 and not any(r["malformed"] for r in got.values())


def test_content_fingerprint_reads_every_cell(spark, movies):
    rows = [tuple(r) for r in movies.collect()]
    make = lambda x, parts=2: tuple(files.content_fingerprint(spark.createDataFrame(x, movies.schema).repartition(parts), "m").first())
    base = make(rows)
    assert base == make(rows[::-1], 5) and base[:2] == ("m", 5)
    assert len({base, make([(1, rows[0][1], None), *rows[1:]]), make([(1, rows[0][1], ""), *rows[1:]]), make(rows + rows[:1]), make([])}) == 5
    # Cells do not run into each other.
    assert make([(1, "ab", "c")]) != make([(1, "a", "bc")])


def test_missing_column(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), ratings_text="userId,movieId,rating\n1,1,5.0\n")
    with pytest.raises(ValueError, match="timestamp"):
        files.check_headers(spark, d)


def test_reordered_columns_bind_by_name(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), movies_text="title,movieId,genres\nToy Story (1995),7,X\n")
    m = CSV.load_movies(spark, d)
    assert m.columns == ["movieId", "title", "genres"]
    assert m.collect()[0].asDict() == {"movieId": 7, "title": "Toy Story (1995)", "genres": "X"}


def test_doubled_quotes(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"),
                          movies_text='movieId,title,genres\n1,"""Great Performances"" Cats (1998)",Musical\n')
    r = CSV.load_movies(spark, d).collect()[0]
    assert r["title"] == '"Great Performances" Cats (1998)'


def test_malformed_cells_are_null(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), movies_text="movieId,title,genres\nbad,Zed,Q\n3,short\n")
    got = sorted(CSV.load_movies(spark, d).collect(), key=lambda r: str(r["title"]))
    assert [tuple(r) for r in got] == [(None, "Zed", "Q"), (3, "short", None)]
    from cofan.operators.quality import cast_failures
    from cofan.schemas import MOVIES_SCHEMA

    text = CSV.read_as_text(spark, os.path.join(d, "movies.csv"))
    fails = {r["column_name"]: r["failures"] for r in cast_failures(text, MOVIES_SCHEMA, "movies").collect()}
    assert fails["movieId"] == 1


def test_fingerprint(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"))
    fp = {r["file_name"]: r["length"] for r in files.fingerprint(spark, d).collect()}
    assert fp == {"ratings.csv": os.path.getsize(os.path.join(d, "ratings.csv")),
                  "movies.csv": os.path.getsize(os.path.join(d, "movies.csv"))}


def test_bom_header_and_inferred_read(spark, tmp_path):
    d = tmp_path / "bom"
    d.mkdir()
    (d / "movies.csv").write_bytes("﻿movieId,title,genres\n1,A (2000),X\n".encode("utf-8"))
    assert CSV.read_header(spark, str(d / "movies.csv")) == ["movieId", "title", "genres"]
    inferred = CSV.read_inferred(spark, str(d / "movies.csv"))
    assert inferred.schema["movieId"].dataType.simpleString() == "int"
    (d / "empty.csv").write_text("")
    assert CSV.read_header(spark, str(d / "empty.csv")) == []


def test_persist_helpers(ratings, movies):
    from cofan.sources import persist_tables, unpersist_tables

    r, m = persist_tables(ratings, movies)
    assert r.storageLevel.useDisk and r.count() == 12
    unpersist_tables(r, m)


def test_total_bytes(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"))
    size = files.total_bytes(spark, d)
    assert size == sum(os.path.getsize(os.path.join(d, f)) for f in ("ratings.csv", "movies.csv"))


def test_parquet_contract_read(spark, tmp_path, ratings, movies):
    from cofan.sources import parquet as P

    d = str(tmp_path / "pq")
    ratings.withColumn("extra", ratings.userId).select("extra", "rating", "movieId", "timestamp", "userId") \
        .write.parquet(os.path.join(d, "ratings"))
    movies.write.parquet(os.path.join(d, "movies"))
    r, m = P.load(spark, d)
    assert r.columns == ["userId", "movieId", "rating", "timestamp"] and r.count() == 12
    assert m.columns == ["movieId", "title", "genres"]
    movies.drop("genres").write.parquet(os.path.join(d, "bad"))
    with pytest.raises(ValueError, match="genres"):
        P.read_contract_parquet(spark, os.path.join(d, "bad"), P.MOVIES_SCHEMA)
