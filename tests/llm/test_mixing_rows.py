"""Source mixing, row by row, against a plain walk over passes, blocks and rows."""

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cofan.llm import mixing

SEED = 7


def hashed(spark, rows, schema):
    """Spark's hash of each row; the rest of the walk is plain Python."""
    df = spark.createDataFrame(rows, schema)
    return {tuple(r)[:-1]: r.h for r in df.select("*", F.xxhash64(F.lit(SEED), *df.columns).alias("h")).collect()}


def brute_exponent(totals, max_repeats=None, target_entropy=None):
    def fits(a):
        p = {s: n**a for s, n in totals.items() if n}
        z = sum(p.values())
        if target_entropy is not None:
            return -sum(x / z * math.log(x / z) for x in p.values()) >= target_entropy
        repeats = [p[s] / totals[s] for s in p]
        return max(repeats) / min(repeats) <= max_repeats

    low, high = 0.0, 1.0  # entropy falls and repeats even out as the exponent grows
    for _ in range(60):
        mid = (low + high) / 2
        if fits(mid) == (target_entropy is not None):
            low = mid
        else:
            high = mid
    return low


def brute_mix(spark, rows, a, budget):
    """(id, pass, block, slot) of every row shown; rows are (id, source, words)."""
    name = {i: "null" if s is None else "s" + s for i, s, _ in rows}
    block_of = {k[0]: h % mixing.BLOCKS for k, h in hashed(spark, [(i,) for i, *_ in rows], "id long").items()}
    blocks, total = defaultdict(list), defaultdict(int)
    for i, _, n in rows:
        blocks[name[i], block_of[i]].append((i, n))
        total[name[i]] += n
    w = {s: n**a if n else 0.0 for s, n in total.items()}
    z = sum(w.values()) or 1.0
    if budget is None:
        budget = max((total[s] / w[s] for s in total if total[s]), default=0.0) * z
    plan = {}
    for s, n in total.items():
        want = max(0, math.floor(w[s] / z * budget + 0.5))
        full = want // n if n else 1
        plan[s] = full, want - full * n if n else 0
    asked = [(s, p, b) for s, b in blocks for p in range(1, plan[s][0] + 2)]
    place = hashed(spark, asked, "src string, pass long, block long")
    row_hash = hashed(spark, [(i, p) for s, p, b in asked for i, _ in blocks[s, b]], "id long, pass long")
    out = []
    for s, (full, rest) in plan.items():
        for p in range(1, full + 2):
            used = 0
            for slot, b in enumerate(sorted((b for t, b in blocks if t == s), key=lambda b: (place[s, p, b], b)), 1):
                size, inside = sum(n for _, n in blocks[s, b]), used
                for i, n in sorted(blocks[s, b], key=lambda x: (row_hash[x[0], p], x[0])):
                    whole = p <= full or rest > 0 and used < rest and used + size <= rest
                    if whole or rest > 0 and used < rest and inside < rest:
                        out.append((i, p, b, slot))
                    inside += n
                used += size
    return sorted(out)


@pytest.mark.parametrize("given", [{}, {"max_repeats": 3.5}, {"max_repeats": 1.0}, {"target_entropy": 1.0}, {"target_entropy": 0.9, "budget_tokens": 3000}, {"budget_tokens": 40_000}, {"budget_tokens": 1}, {"budget_tokens": 0}])
def test_rows_equal_brute_force(spark, monkeypatch, given):
    monkeypatch.setattr(mixing, "BLOCKS", 8)  # blocks of many rows, so that the cut falls inside one
    sizes = {"a": 90, "b": 25, "c": 6, None: 12, "empty": 3}
    docs = [(1000 * k + j, s, None if s == "empty" and j else " ".join(["w"] * ((7 * j + k) % 40 if s != "empty" else 0))) for k, (s, c) in enumerate(sizes.items()) for j in range(c)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, source string, text string, block string").repartition(3)
    rows = [(i, s, len(re.findall(r"\S+", t or ""))) for i, s, t in docs]
    total = defaultdict(int)
    for _, s, n in rows:
        total["null" if s is None else "s" + s] += n
    a = mixing.source_exponent(spark.createDataFrame(list(total.items()), "src string, tokens long"), given.get("max_repeats", 2.0), given.get("target_entropy"))
    assert a == pytest.approx(brute_exponent(total, given.get("max_repeats", 2.0), given.get("target_entropy")), abs=2 * mixing.FAN**-mixing.STEPS)
    got = sorted((r.row.doc_id, r["pass"], r.block, r.slot) for r in mixing.mix(df, **given).collect())
    assert got == brute_mix(spark, rows, a, given.get("budget_tokens"))
