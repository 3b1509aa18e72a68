"""Quantiles of trip measures: exact by bracketing, and mergeable sketches kept per month.

Exact: a rank is narrowed between probes whose places are counted, until few rows lie between two of
them, and is then read off among these rows.  Every pass is a grouped aggregation of fixed-size results
(a sketch, or a handful of counts per group), combined before the shuffle; only the rows of the last bracket are
grouped by value.  So no shuffle carries the rows of a month, and a value that a third of them share is one
row.  The measures are bracketed side by side in the same passes.

Mergeable: one quantile sketch per month and measure is stored; any set of months is answered by merging their
sketches, without reading trips again, and a month that is rebuilt replaces its own sketches only.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

#: Rank accuracy of the first probes (1 / ACCURACY), and probes between two known ones in further rounds.
ACCURACY, FINER = 10000, 32
#: Rows of a group between its probes that are read off directly, and rounds at most to get there.
SELECT_ROWS, MOST_ROUNDS = 1_000_000, 8


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _beside(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of its group's row in ``small`` (one row per group: left to Spark's size check)."""
    return df.join(small, _same(df, small, keys)).drop(*[small[k] for k in keys])


def _probed(slim: DataFrame, names: list[str], keys: list[str], shares: list[float], known: DataFrame | None) -> DataFrame:
    """Per group and measure: probe values, sorted, from the smallest to the greatest value of the bracket."""
    rows = slim if known is None else _beside(slim, known, keys)
    aggs = []
    for v in names:
        x = F.col(v) if known is None else F.when(F.col(v).between(F.col(f"{v}_lower.probe"), F.col(f"{v}_upper.probe")), F.col(v))
        inner = F.percentile_approx(x, F.array(*[F.lit(s) for s in shares]), F.lit(ACCURACY))
        aggs.append(F.array_sort(F.array_distinct(F.concat(F.array(F.min(x), F.max(x)), inner))).alias(f"{v}_probes"))
    return rows.groupBy(*keys).agg(*aggs)


def _with(count: str, sign: str, rank: Column):
    return lambda s: s[count] <= rank if sign == "<=" else s[count] > rank


def _counted(slim: DataFrame, probes: DataFrame, names: list[str], keys: list[str], p: float, most: int) -> DataFrame:
    """Per group: n of each measure and the nearest probes around the ranks of its quantile, with exact counts."""
    rows = _beside(slim, probes, keys)
    aggs = [F.first(f"{v}_probes").alias(f"{v}_probes") for v in names] + [F.count(v).alias(f"{v}_n") for v in names]
    for v in names:
        for j in range(most):
            at = F.get(f"{v}_probes", F.lit(j))
            aggs += [F.count_if(F.col(v) < at).alias(f"{v}_lt_{j}"), F.count_if(F.col(v) <= at).alias(f"{v}_le_{j}")]
    out = rows.groupBy(*keys).agg(*aggs)
    cols = [*keys]
    for v in names:
        place = F.lit(p) * (F.col(f"{v}_n") - 1)
        low, high = F.floor(place), F.ceil(place)
        seen = F.filter(F.array(*[F.struct(F.get(f"{v}_probes", F.lit(j)).alias("probe"), F.col(f"{v}_lt_{j}").alias("lt"),
                                           F.col(f"{v}_le_{j}").alias("le")) for j in range(most)]),
                        lambda s: s["probe"].isNotNull())
        cols += [F.col(f"{v}_n"), low.alias(f"{v}_low"), high.alias(f"{v}_high"), (place - low).alias(f"{v}_frac"),
                 F.array_max(F.filter(seen, _with("lt", "<=", low))).alias(f"{v}_lower"),
                 F.array_min(F.filter(seen, _with("le", ">", high))).alias(f"{v}_upper")]
    return out.select(*cols)


def brackets(slim: DataFrame, names: list[str], p: float, keys: list[str], select_rows: int = SELECT_ROWS) -> DataFrame:
    """One row per group; of each measure: n, the two ranks of the quantile, and ``lower`` / ``upper`` (probe, rows below,
    rows at or below) around them, with at most about ``select_rows`` rows between."""
    near = [p, *[p + s / ACCURACY for d in (2, 20, 200) for s in (-d, d)]]
    known = None
    for _ in range(MOST_ROUNDS):
        shares = sorted({min(1.0, max(0.0, s)) for s in near}) if known is None else [i / FINER for i in range(1, FINER)]
        probes = reliable_checkpoint(_probed(slim, names, keys, shares, known), "quantile-probes")
        known = reliable_checkpoint(_counted(slim, probes, names, keys, p, len(shares) + 2), "quantile-brackets")
        between = [F.coalesce(F.when(F.col(f"{v}_lower.probe") < F.col(f"{v}_upper.probe"),
                                     F.col(f"{v}_upper.lt") - F.col(f"{v}_lower.le")), F.lit(0)) for v in names]
        most = known.agg(F.max(F.greatest(*between) if len(between) > 1 else between[0])).first()[0]  # one number
        if most is None or most <= select_rows:
            break
    return known


def candidates(slim: DataFrame, known: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """(keys, measure, v, rows) of the values inside the brackets."""
    rows = _beside(slim, known.select(*keys, *[f"{v}_{e}" for v in names for e in ("lower", "upper")]), keys)
    inside = {v: F.col(v).between(F.col(f"{v}_lower.probe"), F.col(f"{v}_upper.probe")) for v in names}
    some = rows.where(reduce(lambda a, b: a | b, inside.values()))
    held = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(v).alias("measure"), F.col(v).alias("v")))
                                     for v, c in inside.items()]))
    return some.select(*keys, F.explode(held).alias("m")).groupBy(*keys, "m.measure", "m.v").agg(
        F.count(F.lit(1)).alias("rows"))


def exact_quantiles(df: DataFrame, values: dict[str, Column | str], p: float, keys: list[str],
                    select_rows: int = SELECT_ROWS) -> DataFrame:
    """One row per group: the exact p-quantile of every measure (linear interpolation, as ``percentile``).

    Null and NaN values do not count; a measure without values is null.  Groups may have null keys.  ``df``
    is scanned three times (probes, counts, candidates), twice more for every further round.
    """
    keys, made = list(keys), not keys
    names = [f"_q{i}" for i in range(len(values))]
    cols = [(F.col(v) if isinstance(v, str) else v).cast("double") for v in values.values()]
    slim = df.select(*keys, *([F.lit(0).alias("_all")] if made else []),
                     *[F.when(~F.isnan(c), c).alias(n) for c, n in zip(cols, names, strict=True)])
    on = keys or ["_all"]
    known = brackets(slim, names, p, on, select_rows)
    held = reliable_checkpoint(candidates(slim, known, names, on), "quantile-candidates")
    upto = Window.partitionBy(*on, "measure").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _beside(held.withColumn("upto", F.sum("rows").over(upto)), known, on)
    aggs = []
    for n in names:
        # rows at or below a value: those below the bracket, and those of it up to the value
        seen = F.when(F.col("measure") == n, F.col("upto") + F.col(f"{n}_lower.lt"))
        low, high = (F.min(F.when(seen > F.col(f"{n}_{e}"), F.col("v"))) for e in ("low", "high"))
        aggs.append(F.when(low == high, low).otherwise(low + F.first(f"{n}_frac") * (high - low)).alias(n))
    found = ranked.groupBy(*on).agg(*aggs)
    every = known.select(*on)
    out = every.join(found, _same(every, found, on), "left").select(
        *[every[k] for k in keys], *[F.col(n).alias(v) for n, v in zip(names, values, strict=True)])
    return out


# ------------------------------------------------------------ mergeable sketches
def sketch_size(rel_err: float) -> int:
    """The size parameter for which the sketch's rank error stays below ``rel_err`` (with 99 % confidence).

    The error falls as 2.296 / k^0.9021 (the published error of this sketch).
    """
    return int(min(65535, max(8, -(-(2.296 / rel_err) ** (1 / 0.9021) // 1))))


def month_sketches(df: DataFrame, values: dict[str, Column | str], keys: list[str], rel_err: float = 0.0005) -> DataFrame:
    """One row per month: of each measure a quantile sketch (null without values) and the number of its values."""
    k, aggs = sketch_size(rel_err), []
    for name, v in values.items():
        x = (F.col(v) if isinstance(v, str) else v).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.when(F.count(x) > 0, F.kll_sketch_agg_double(x, F.lit(k))).alias(f"{name}_sketch"), F.count(x).alias(f"{name}_n")]
    return df.groupBy(*keys).agg(*aggs)


def merged_quantiles(sketches: DataFrame, names: list[str], p: float, by: list[str] | None = None) -> DataFrame:
    """The p-quantile of every measure over groups of months (all by default), from the months' sketches alone."""
    aggs = []
    for name in names:
        aggs += [F.when(F.sum(f"{name}_n") > 0, F.kll_sketch_get_quantile_double(
            F.kll_merge_agg_double(f"{name}_sketch"), F.lit(float(p)))).alias(name), F.sum(f"{name}_n").alias(f"{name}_n")]
    return sketches.groupBy(*(by or [])).agg(*aggs)


def rank_errors(df: DataFrame, values: dict[str, Column | str], bounds: DataFrame, p: float,
                by: list[str] | None = None) -> DataFrame:
    """(by, measure, n, rank_error): how far each bound of ``bounds`` is from rank p among the rows of ``df``.

    0 when the bound's own rows span the rank; else the share of rows between.
    """
    on = list(by or [])
    cols = {n: (F.col(v) if isinstance(v, str) else v).cast("double") for n, v in values.items()}
    slim = df.select(*on, *[F.when(~F.isnan(c), c).alias(f"_v_{n}") for n, c in cols.items()])
    if on:
        rows = _beside(slim, bounds, on)
    else:
        one = bounds.select(F.struct(*values).alias("b"))
        rows = slim.select("*", one.scalar().alias("b")).select("*", "b.*")
    aggs = [f(F.col(f"_v_{n}"), F.col(n)).alias(f"{n}_{s}") for n in values for s, f in (
        ("n", lambda v, b: F.count(v)), ("lt", lambda v, b: F.count_if(v < b)), ("le", lambda v, b: F.count_if(v <= b)))]
    counts = rows.groupBy(*on).agg(*aggs)
    each = [F.struct(F.lit(n).alias("measure"), F.col(f"{n}_n").alias("n"), F.greatest(
        F.lit(0.0), F.col(f"{n}_lt") / F.col(f"{n}_n") - p, p - F.col(f"{n}_le") / F.col(f"{n}_n")).alias("rank_error"))
        for n in values]
    return counts.select(*on, F.explode(F.array(*each)).alias("e")).select(*on, "e.*")
