"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_REPS`` timed executions
(median kept).  Each execution runs the whole plan through the ``noop`` sink,
so no result rows are shipped to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "similar_items_exact",
    "similar_items_substring",
    "similar_items_batch",
    "corated_by_id",
    "top_movies",
    "most_rated_top10",
    "mean_rating_group_count",
    "dataset_overview",
    "rating_distribution",
    "genre_summary",
    "catalog_best_match",
    "sample_vs_full",
    "null_profile",
    "title_functions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = sys.argv[1:] or HEADLINE

    from cofan.plans.queries import REGISTRY
    from cofan.session import local_session
    from cofan.sources import testdata

    # One shuffle partition per core; AQE coalesces further and splits skew.
    spark = local_session(cpus, shuffle_partitions=int(cpus), app_name="cofan-bench")
    times: dict[str, float] = {}
    t_start = time.time()
    failed: dict[str, str] = {}
    for name in names:
        fn = REGISTRY[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            runs = []
            for _ in range(reps):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 4)
        except Exception as error:  # noqa: BLE001 - report, keep measuring the rest
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"

    ratings, _ = testdata.load(spark, sf_dir)
    n_ratings = ratings.count()

    # Marginal throughput of the grouped mean: rows added between a smaller
    # sibling scale factor and this one, over the time added.  It separates
    # per-row cost from the fixed per-stage scheduling cost that dominates at
    # small scale factors.
    marginal = None
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if "mean_rating_group_count" in times and os.path.isdir(small_dir) and small_dir != sf_dir.rstrip("/"):
        fn = REGISTRY["mean_rating_group_count"]
        fn(spark, small_dir).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, small_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        small_rows = testdata.load(spark, small_dir)[0].count()
        dt = times["mean_rating_group_count"] - statistics.median(runs)
        if dt > 0:
            marginal = round((n_ratings - small_rows) / dt)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "ratings_rows": n_ratings,
        "group_mean_rows_per_sec": round(n_ratings / times["mean_rating_group_count"])
        if "mean_rating_group_count" in times else None,
        "group_mean_marginal_rows_per_sec": marginal,
        "wall_sec": round(time.time() - t_start, 2),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
