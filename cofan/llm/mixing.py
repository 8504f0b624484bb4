"""Mixing sources to target weights by temperature.

Source token shares are raised to an exponent in [0, 1] and normalised.  The
exponent is found by repeated subdivision (each step halves the interval four
times) as the smallest whose most repeated source is seen at most
``max_repeats`` times as often as the least repeated one, or, with
``target_entropy``, the largest whose weights reach that entropy in nats.  The
weights are realised as block permutations within a token budget: each source's
rows are dealt over ``BLOCKS`` blocks by a hash, every pass takes the blocks in
an order of its own, and the last pass stops inside one block, whose rows are
taken in hash order while they start inside the budget.

The default budget shows the least repeated source exactly once, so that no row
is lost.  Only DataFrame functions are used; the per-source totals stay in a
table and the driver sees sums over them.

Null or empty text has no tokens and goes with every full pass of its block;
null sources form one source; repeated rows are mixed each; an empty table gives
an empty result.  Working columns have names that input columns cannot clash
with, as input columns are carried in one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofan.llm.common import written

BLOCKS = 1024
STEPS = 6
FAN = 16  # parts that one step cuts the interval into


def token_count(text) -> F.Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(gaps, r"[\x20\x09-\x0D]+", "")).cast("long")


def source_exponent(totals: DataFrame, max_repeats: float, target_entropy: float | None) -> float:
    """The exponent for per-source totals (src, tokens)."""
    shares = totals.filter("tokens > 0")
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        grid = [low + (high - low) * k / FAN for k in range(FAN + 1)]
        at = F.explode(F.array(*[F.lit(a) for a in grid])).alias("a")
        raised = shares.select("tokens", at).withColumn("p", F.pow(F.col("tokens").cast("double"), F.col("a")))
        # Entropy of p / z is ln z - sum(p ln p) / z.
        rows = raised.groupBy("a").agg(
            F.sum("p").alias("z"), F.sum(F.col("p") * F.log("p")).alias("plogp"),
            F.max(F.col("p") / F.col("tokens")).alias("most"), F.min(F.col("p") / F.col("tokens")).alias("least"),
        ).orderBy("a").select("a", (F.log("z") - F.col("plogp") / F.col("z")).alias("h"), (F.col("most") / F.col("least")).alias("r")).collect()
        if not rows:
            return 1.0
        if target_entropy is None:
            ok = [x["a"] for x in rows if x["r"] <= max_repeats * (1 + 1e-12)]
            high = min(ok, default=1.0)
            low = max([x["a"] for x in rows if x["a"] < high], default=0.0)
        else:
            ok = [x["a"] for x in rows if x["h"] >= target_entropy]
            low = max(ok, default=0.0)
            high = min([x["a"] for x in rows if x["a"] > low], default=1.0)
        if low >= high:
            break
    return high if target_entropy is None else low


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_repeats: float = 2.0, target_entropy: float | None = None, budget_tokens: int | None = None, seed: int = 7) -> DataFrame:
    """``row`` (the input row as a struct), ``src, pass, block, slot`` for every
    time a row is shown; ``slot`` is the block's place in its pass."""
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(source_col).cast("string").alias("src0"),
        F.col(id_col).alias("id"), token_count(F.col(text_col)).alias("tokens"),
    ).select(
        "row", "id", "tokens", F.coalesce(F.concat(F.lit("s"), "src0"), F.lit("null")).alias("src"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(BLOCKS)).alias("block"),
    )
    blocks = written(rows.groupBy("src", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    totals = blocks.groupBy("src").agg(F.sum("tokens").alias("tokens"))
    a = source_exponent(totals, max_repeats, target_entropy)
    raised = totals.withColumn("w", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(0.0))
    one = raised.agg(F.sum("w").alias("z"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("w"))).alias("once")).first()
    z = one["z"] or 1.0
    budget = float(budget_tokens) if budget_tokens is not None else (one["once"] or 0.0) * z
    # Tokens that a source shows; a hair under a whole pass counts as whole.
    want = raised.select(
        "src", F.col("tokens").alias("all_tokens"), F.greatest(F.lit(0), F.round(F.col("w") / z * budget)).cast("long").alias("want"),
    ).withColumn("full", F.when(F.col("all_tokens") > 0, F.floor(F.col("want") / F.col("all_tokens"))).otherwise(1)).withColumn(
        "rest", F.when(F.col("all_tokens") > 0, F.col("want") - F.col("full") * F.col("all_tokens")).otherwise(0))
    passes = blocks.join(want, "src").withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("full") + 1)))
    order = Window.partitionBy("src", "pass").orderBy(F.xxhash64(F.lit(seed), "src", "pass", "block"), "block")
    placed = passes.withColumn("slot", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plan = placed.select(
        "src", "block", "pass", "slot",
        F.when(F.col("pass") <= F.col("full"), F.lit(None).cast("long"))
        .when(F.col("before") + F.col("tokens") <= F.col("rest"), F.lit(None).cast("long"))
        .otherwise(F.col("rest") - F.col("before")).alias("room"),
        ((F.col("pass") <= F.col("full")) | ((F.col("rest") > 0) & (F.col("before") < F.col("rest")))).alias("shown"),
    ).filter("shown").drop("shown")
    shown = rows.join(plan, ["src", "block"])
    cols = ["row", "src", "pass", "block", "slot"]
    inside = Window.partitionBy("src", "block", "pass").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    cut = shown.filter("room IS NOT NULL").withColumn("h", F.xxhash64(F.lit(seed), "id", "pass")).withColumn(
        "start", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).filter("start < room")
    return shown.filter("room IS NULL").select(cols).unionByName(cut.select(cols))
