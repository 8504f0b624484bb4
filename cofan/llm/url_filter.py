"""URL filtering by rules and gradient-boosted trees on lexical features.

A rule is (verdict, host, path): it fits its host and all subdomains when the
URL's path starts with the rule's, and the longest fitting rule wins.  URLs that
a rule decides are the labelled URLs; boosted trees of depth two on binned
lexical features (length, depth, digit ratio, entropy, parameter count, suffix
statistics) decide the others.

Training sums rows per combination of bins (at most the product of the bin
counts, whatever the input), and each tree level is one aggregate of gradients
over that table; the driver receives one row per leaf, feature and bin.  Only
DataFrame functions are used.

Null URLs and URLs without ``://`` have empty host and path and are judged by
the trees; without any labelled URL the method allows.  Repeated rows are
judged each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofan.llm.common import written

TREES, RATE, SMOOTH = 8, 0.4, 1.0
CUTS = {
    "f_length": [25, 35, 45, 60, 90],
    "f_depth": [1, 2, 3, 4],
    "f_digits": [0.02, 0.08, 0.15, 0.25, 0.4],
    "f_entropy": [3.6, 3.9, 4.2, 4.5],
    "f_params": [1, 2, 4],
    "f_suffix": [0.2, 0.4, 0.6, 0.8],
}
#: Fixed values of the query.
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def parts(url) -> tuple[F.Column, F.Column]:
    """(host, path) of a URL column; null or no ``://`` gives empty strings."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host, path, rules: list[tuple[str, str, str]]) -> tuple[F.Column, F.Column]:
    """(rule text, verdict) of the longest fitting rule, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _features(url, host, path) -> dict[str, F.Column]:
    text = F.coalesce(url, F.lit(""))
    size = F.length(text)
    chars = F.split(text, "")
    seen = F.array_distinct(chars)
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / F.greatest(size, F.lit(1))
    entropy = F.aggregate(F.filter(seen, lambda c: c != ""), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    return {
        "f_length": size.cast("double"),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "f_digits": F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(size, F.lit(1)),
        "f_entropy": entropy,
        "f_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "[&;]")).cast("double")),
    }


def _bin(col, cuts: list[float]) -> F.Column:
    out = F.lit(0)
    for c in cuts:
        out = out + (col >= c).cast("int")
    return out


def _margin(trees: list, base: float) -> F.Column:
    out = F.lit(base)
    for tree in trees:
        out = out + _tree(tree)
    return out


def _tree(tree) -> F.Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, cut, left, right = tree
    return F.when(F.col(feature) < cut, _tree(left)).otherwise(_tree(right))


def _best(sums: list[tuple[str, int, float, float]]) -> tuple[str, int] | None:
    """The split with the largest gain, from gradient sums per feature and bin."""
    best, at = 1e-9, None
    for f in CUTS:
        own = {b: (g, h) for name, b, g, h in sums if name == f}
        tg, th = sum(g for g, _ in own.values()), sum(h for _, h in own.values())
        for cut in range(1, len(CUTS[f]) + 1):
            lg, lh = (sum(v[k] for b, v in own.items() if b < cut) for k in (0, 1))
            if (lh <= 0) or (th - lh <= 0):
                continue
            gain = lg * lg / (lh + SMOOTH) + (tg - lg) ** 2 / (th - lh + SMOOTH) - tg * tg / (th + SMOOTH)
            if gain > best:
                best, at = gain, (f, cut)
    return at


def train(cells: DataFrame) -> tuple[list, float]:
    """Trees and base margin from ``cells``: bins, n rows and n_block of them."""
    total = cells.agg(F.sum("n").alias("n"), F.sum("n_block").alias("b")).first()
    if not total["n"]:
        return [], -1.0
    base = math.log((total["b"] + 0.5) / (total["n"] - total["b"] + 0.5))
    trees: list = []
    unpivot = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in CUTS])).alias("fb")

    def sums(leaf) -> list:
        p = 1 / (1 + F.exp(-_margin(trees, base)))
        rows = cells.select(leaf.alias("leaf"), unpivot, (F.col("n_block") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
        return rows.groupBy("leaf", "fb.f", "fb.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()

    for _ in range(TREES):
        root = _best([(r["f"], r["b"], r["g"], r["h"]) for r in sums(F.lit(0))])
        if root is None:
            break
        got = sums((F.col(root[0]) >= root[1]).cast("int"))
        sides = []
        for leaf in (0, 1):
            own = [(r["f"], r["b"], r["g"], r["h"]) for r in got if r["leaf"] == leaf]
            value = lambda rows: float(RATE * sum(r[2] for r in rows) / (sum(r[3] for r in rows) + SMOOTH))
            split = _best(own)
            if split is None:
                sides.append(value([r for r in own if r[0] == root[0]]))
            else:
                of = [r for r in own if r[0] == split[0]]
                sides.append((*split, value([r for r in of if r[1] < split[1]]), value([r for r in of if r[1] >= split[1]])))
        trees.append((*root, *sides))
    return trees, base


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block``."""
    u = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = parts(F.col("url"))
    u = u.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    u = u.select("*", rule.alias("rule"), said.alias("said"), F.element_at(F.split("host", r"\."), -1).alias("suffix"))
    # Suffix statistics: the smoothed share of blocked URLs among the labelled ones.
    stats = u.filter("said IS NOT NULL").groupBy("suffix").agg(((F.sum((F.col("said") == "block").cast("int")) + 1) / (F.count("*") + 2)).alias("f_suffix"))
    u = u.join(written(stats, "url-suffix"), "suffix", "left")
    values = _features(F.col("url"), F.col("host"), F.col("path")) | {"f_suffix": F.coalesce("f_suffix", F.lit(0.5))}
    u = written(u.select("page_id", "host", "path", "rule", "said", *[_bin(v, CUTS[f]).alias(f) for f, v in values.items()]), "url-bins")
    cells = written(u.filter("said IS NOT NULL").groupBy(*CUTS).agg(F.count("*").alias("n"), F.sum((F.col("said") == "block").cast("long")).alias("n_block")), "url-cells")
    trees, base = train(cells)
    p = 1 / (1 + F.exp(-_margin(trees, base)))
    return u.select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"), p.alias("p_block"),
    )
