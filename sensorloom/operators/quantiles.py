"""Exact quantiles that never bring the values of a column into one task.

Small columns use Spark's own ``percentile``.  For large ones, an approximate sketch
brackets the wanted ranks, rows outside the bracket are only counted, and the bracket is
narrowed until few distinct values are left to rank.  The rank counts are exact, so the
result is exact; a bracket that misses its rank is widened, never trusted.
"""

from dataclasses import dataclass
from math import floor

from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.workspace import materialize

# Values a column may have before ranks are searched instead of aggregated directly.
DIRECT_ROWS = 1_000_000
ACCURACY = 10_000
MARGIN = 3.0  # sketch errors on either side of the wanted rank that a bracket covers


@dataclass
class _Bracket:
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0


def _in(column, b: _Bracket):
    value = F.col(column)
    keep = value.isNotNull()
    if b.low is not None:
        keep = keep & (value >= b.low)
    if b.high is not None:
        keep = keep & (value <= b.high)
    return F.when(keep, value.cast("double"))


def order_statistics(df: DataFrame, ranks: dict[str, list[list[int]]], counts: dict[str, int],
                     limit: int = DIRECT_ROWS) -> dict[str, list[list[float]]]:
    """For each column, the values at the given 0-based rank groups (one bracket per group)."""
    keys = [(c, i) for c, groups in ranks.items() for i in range(len(groups))]
    brackets = {k: _Bracket(inside=counts[k[0]]) for k in keys}
    margin, open_keys = 2.0 / ACCURACY, {k for k in keys if brackets[k].inside > limit}
    known: dict[tuple[str, int], list[float]] = {}
    while open_keys:
        order = sorted(open_keys)
        asked = []
        for c, i in order:
            b, wanted = brackets[c, i], ranks[c][i]
            share = lambda r: (r - b.below) / max(1, b.inside - 1)
            edges = [max(0.0, share(min(wanted)) - margin), min(1.0, share(max(wanted)) + margin)]
            asked.append(F.percentile_approx(_in(c, b), edges, ACCURACY))
        edges = df.agg(*[a.alias(f"e{n}") for n, a in enumerate(asked)]).first()
        tried = {k: _Bracket(*edges[n]) for n, k in enumerate(order)}
        counted = df.agg(*[x for n, (k, b) in enumerate(tried.items()) for x in (
            F.count_if(F.col(k[0]) < b.low).alias(f"b{n}"),
            F.count(_in(k[0], b)).alias(f"i{n}"))]).first()
        missed = False
        for n, k in enumerate(order):
            b, old = tried[k], brackets[k]
            b.below, b.inside = counted[f"b{n}"], counted[f"i{n}"]
            if b.below > min(ranks[k[0]][k[1]]) or b.below + b.inside <= max(ranks[k[0]][k[1]]):
                missed = True
                continue
            stuck = (b.low, b.high) == (old.low, old.high)
            brackets[k] = b
            if stuck and b.inside > limit and b.low < b.high:
                # Frequent values at the edges hold the sketch there; step inside them.
                known[k] = _past_edges(df, k[0], b, ranks[k[0]][k[1]])
            if k in known and known[k] or b.inside <= limit or b.low == b.high:
                open_keys.discard(k)
        margin = margin * 4 if missed else 2.0 / ACCURACY
    return {c: [known.get((c, i)) or _pick(df, c, brackets[c, i], group) for i, group in enumerate(groups)]
            for c, groups in ranks.items()}


def _past_edges(df: DataFrame, column: str, b: _Bracket, wanted: list[int]) -> list[float]:
    """Values at the wanted ranks if they lie on the edges of the bracket or next to them; else none, and the bracket loses
    its edges."""
    v = _in(column, b)
    edge = df.agg(F.count_if(v == b.low).alias("n_low"), F.count_if(v == b.high).alias("n_high"),
                  F.min(F.when(v > b.low, v)).alias("next"), F.max(F.when(v < b.high, v)).alias("last")).first()
    first, last = b.below + edge.n_low, b.below + b.inside - edge.n_high - 1  # ranks between the edges
    value = lambda r: (b.low if r < first else b.high if r > last else edge["next"] if r == first
                       else edge["last"] if r == last else None)
    found = [value(r) for r in wanted]
    if None not in found:
        return found
    b.low, b.high, b.below, b.inside = edge["next"], edge["last"], first, last - first + 1
    return []


def _pick(df: DataFrame, column: str, b: _Bracket, wanted: list[int]) -> list[float]:
    if b.low is not None and b.low == b.high:
        return [b.low] * len(wanted)
    # Ties collapse to one row each before the values are put in order.
    values = (df.select(_in(column, b).alias("v")).where("v IS NOT NULL")
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.select("v", "n", F.sum("n").over(upto).alias("upto"))
    found = []
    for r in sorted(set(wanted)):
        local = r - b.below
        found.append(F.min(F.when(F.col("upto") > local, F.col("v"))).alias(f"r{r}"))
    row = placed.agg(*found).first()
    return [row[f"r{r}"] for r in wanted]


def rank_of(n: int, p: float) -> tuple[list[int], float]:
    """Neighbouring ranks of a linear-interpolated quantile, and the weight of the upper one."""
    at = (n - 1) * p
    low = min(n - 1, floor(at))
    return [low, min(n - 1, low + 1)], at - low


def blend(pair: list[float], weight: float) -> float:
    return pair[0] if weight == 0 else pair[0] + (pair[1] - pair[0]) * weight


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    limit: int = DIRECT_ROWS) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column, nulls ignored; one list per column."""
    if df.count() <= limit:
        row = df.agg(*[F.percentile(c, F.lit(probabilities)).alias(c) for c in columns]).first()
        return {c: row[c] if row[c] is not None else [None] * len(probabilities) for c in columns}
    # Several passes follow: store the columns once rather than compute them each time.
    df = materialize(df.select(*columns), "quantiles")
    counted = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    counts = {c: counted[c] for c in columns}
    plan = {c: [rank_of(counts[c], p) for p in probabilities] for c in columns if counts[c]}
    picked = order_statistics(df, {c: [r for r, _ in groups] for c, groups in plan.items()},
                              counts, limit)
    return {c: [blend(v, w) for v, (_, w) in zip(picked[c], plan[c])] if c in plan
            else [None] * len(probabilities) for c in columns}


def _at_rank(counted: DataFrame, keys: list[str], p: float, upto) -> DataFrame:
    """Quantile of each group from its values in order: keys, n, value, and whether the wanted ranks are missing.

    ``counted`` has keys, _n (rows of the group), _v and _c (its values and how often they occur); ``upto`` counts rows up to a value.
    """
    at = (F.col("_n") - 1) * F.lit(p)
    placed = counted.withColumns({"_upto": upto, "_at": at, "_low": F.floor(at)})
    lo = F.min(F.when(F.col("_upto") > F.col("_low"), F.struct("_upto", "_v")))
    hi = F.min(F.when(F.col("_upto") > F.least(F.col("_low") + 1, F.col("_n") - 1), F.struct("_upto", "_v")))
    out = placed.groupBy(*keys).agg(
        F.first("_n").alias("n"), F.first("_at").alias("_at"), F.first("_low").alias("_low"),
        lo.alias("_lo"), hi.alias("_hi"))
    a, b = F.col("_lo._v"), F.col("_hi._v")
    return out.select(*keys, "n", (a + (b - a) * (F.col("_at") - F.col("_low"))).cast("double").alias("value"),
                      (a.isNull() | b.isNull()).alias("missed"))


def _same_keys(left: str, right: str, keys: list[str]) -> list:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _quantile_by_ranges(df: DataFrame, keys: list[str], column: str, p: float) -> DataFrame:
    """Quantile of each group from all its values, sorted in ranges that split a group of any size."""
    counted = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    # Stored, since two readers must see the same ranges.
    ranges = materialize(counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    # A row for each range and group in it.
    along = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("_part", *keys).agg(F.sum("_c").alias("_rows")).withColumns({
        "_before": F.coalesce(F.sum("_rows").over(along), F.lit(0)), "_n": F.sum("_rows").over(Window.partitionBy(*keys))})
    joined = ranges.alias("r").join(parts.alias("p"), [F.col("r._part") == F.col("p._part"), *_same_keys("r", "p", keys)]).select(
        "r._part", *[f"r.{k}" for k in keys], "_v", "_c", "_before", "_n")
    inside = Window.partitionBy("_part", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return _at_rank(joined, keys, p, F.col("_before") + F.sum("_c").over(inside))


def group_quantile(df: DataFrame, keys: list[str], column: str, p: float) -> DataFrame:
    """Exact linear-interpolated quantile per group: keys, n, value.

    A group of any size is reduced to a sketch, then to the counts of the few values
    around the wanted rank; the group itself is never gathered. Groups whose sketch misses the rank are ranked in full, over ranges.
    """
    margin = MARGIN / ACCURACY
    edges = [max(0.0, p - margin), min(1.0, p + margin)]
    sketch = df.groupBy(*keys).agg(
        F.percentile_approx(column, edges, ACCURACY).alias("_e"), F.count(column).alias("_n"))
    value, edge = F.col(f"d.{column}"), F.col("s._e")
    # The margin spans several ranks only in groups larger than the sketch; smaller ones keep
    # all their values.
    whole = F.col("s._n") <= ACCURACY
    # Values under the bracket share one cell, values over it are not needed.
    near = (df.alias("d").join(sketch.alias("s"), _same_keys("d", "s", keys))
            .where(value.isNotNull() & (whole | (value <= edge[1])))
            .select(*[F.col(f"d.{k}").alias(k) for k in keys], F.col("s._n").alias("_n"),
                    F.when(whole | (value >= edge[0]), value).alias("_v"))
            .groupBy(*keys, "_n", "_v").agg(F.count(F.lit(1)).alias("_c")))
    along = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(
        Window.unboundedPreceding, 0)
    found = materialize(_at_rank(near, keys, p, F.sum("_c").over(along)), "quantiles")
    missed = found.where("missed").select(*keys)
    if missed.isEmpty():
        return found.drop("missed")
    left = df.alias("d").join(missed.alias("m"), _same_keys("d", "m", keys), "left_semi")
    return found.where("NOT missed").unionByName(_quantile_by_ranges(left, keys, column, p)).drop("missed")
