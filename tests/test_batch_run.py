import os

import pytest

from cofan.plans import batch_run
from tests.conftest import write_fixture_csv


def test_run_writes_outputs_and_record(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"))
    out = str(tmp_path / "out")
    rec = batch_run.run(spark, d, out, movie_title="Toy Story", top_n=3, processed_top_n=5)
    assert rec["status"] == "success"
    assert rec["row_counts"] == {"ratings": 12, "movies": 5, "processed_top_movies": 5, "sample_recommendations": 3}
    top = spark.read.option("header", True).csv(os.path.join(out, "top_movies")).collect()
    assert [r["movieId"] for r in top] == ["1", "2571", "318", "79132", "2"]
    recs = batch_run.read_run_records(spark, out).collect()
    assert recs[0]["status"] == "success" and recs[0]["completed_at"].endswith("+00:00")


def test_failure_record_then_raise(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"))
    out = str(tmp_path / "out")
    with pytest.raises(ValueError):
        batch_run.run(spark, d, out, movie_title="zzz")
    r = batch_run.read_run_records(spark, out).collect()[0]
    assert r["status"] == "failed" and r["error"]["type"] == "ValueError"


def test_missing_input_still_records_failure(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        batch_run.run(spark, str(tmp_path / "absent"), out)
    r = batch_run.read_run_records(spark, out).collect()[0]
    assert r["status"] == "failed" and r["error"]["type"] == "FileNotFoundError"


def test_sharded_snapshot_with_mixed_headers_by_url(spark, tmp_path, ratings, movies):
    d, out = str(tmp_path / "snap"), "file://" + str(tmp_path / "out")
    ratings.repartition(3).write.option("header", True).csv(os.path.join(d, "ratings.csv"))
    movies.write.option("header", True).csv(os.path.join(d, "movies.csv"))
    with open(os.path.join(d, "movies.csv", "part-x.csv"), "w", encoding="utf-8") as f:
        f.write("title,movieId,genres\nZed (2001),99,Drama\n")
    rec = batch_run.run(spark, "file://" + d, out, top_n=2, processed_top_n=3)
    assert rec["row_counts"] == {"ratings": 12, "movies": 6, "processed_top_movies": 3, "sample_recommendations": 2}
    assert rec["stages"] == ["check", "process", "recommend"] and len(rec["facts"]["check"]["headers"]["movies.csv"]) == 2
    zone = spark.read.parquet(out + "/processed/movies")
    assert zone.filter("movieId = 99").first()["title"] == "Zed (2001)"


def test_stages_run_alone(spark, tmp_path):
    d, out = write_fixture_csv(str(tmp_path / "snap")), str(tmp_path / "out")
    assert set(batch_run.check(spark, d).facts["bytes"]) == {"ratings.csv", "movies.csv"}
    assert batch_run.process(spark, d, out, 2).rows == {"ratings": 12, "movies": 5, "processed_top_movies": 2}
    again = batch_run.recommend(spark, out, "matrix", 1)
    assert again.rows == {"sample_recommendations": 1} and again.facts == {"movie_title": "matrix"}


def test_bad_header_stops_before_processing(spark, tmp_path):
    d = write_fixture_csv(str(tmp_path / "snap"), ratings_text="userId,movieId,rating\n1,1,5.0\n")
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="timestamp"):
        batch_run.run(spark, d, out)
    r = batch_run.read_run_records(spark, out).collect()[0]
    assert r["status"] == "failed" and r["stages"] == [] and not os.path.exists(os.path.join(out, "processed"))
