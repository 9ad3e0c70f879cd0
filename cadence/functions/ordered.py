"""Running totals in a global order, without a single-partition window.

An un-partitioned ``Window.orderBy`` pulls every row into one task. Here the
rows are range-partitioned by a global sort (Spark samples the keys, so the
partitions are balanced even when one key value is very frequent, as long as
the order includes a tie-breaker), the sorted result is checkpointed to fix
the partition boundaries, per-partition totals (one row per partition: a
bounded table) become broadcast offsets, and the running sum inside each
partition is an ordinary partitioned window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir, materialize

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id: low 33 bits = row in partition


def _sum_type(t: str) -> str:
    return "long" if t in ("tinyint", "smallint", "int", "bigint") else "double"


def running_totals(df: DataFrame, order: list[Column], sum_cols: list[str],
                   prefix: str = "cum_", row_number_col: str | None = "row_no",
                   next_cols: Sequence[str] = ()) -> DataFrame:
    """Append inclusive running sums ``prefix+c`` for each ``c`` in
    ``sum_cols``, (optionally) a 1-based global row number, and ``next_+c``, the
    value of the following row, for each ``c`` in ``next_cols``, in the order
    ``order``. Use a total order (add a unique tie-breaker) when the row number
    or a per-row running sum must be deterministic."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = (
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
        .checkpoint(eager=True)
    )
    # One row per partition (bounded by the partition count, as in RDD.zipWithIndex):
    # exclusive prefix sums over partitions become a broadcast offset table.
    part_tot = ranked.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sum_cols],
        *[F.min_by(c, "_pos").alias(f"_f_{c}") for c in next_cols]).collect()
    types = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    acc = {"_n": 0} | {f"_t_{c}": 0 if _sum_type(types[c]) == "long" else 0.0 for c in sum_cols}
    rows = []
    parts = sorted(part_tot, key=lambda r: r["_part"])
    for r, after in zip_longest(parts, parts[1:]):
        rows.append((r["_part"], acc["_n"], *[acc[f"_t_{c}"] for c in sum_cols],
                     *[after and after[f"_f_{c}"] for c in next_cols]))
        for k in acc:
            acc[k] += r[k] or 0
    schema = ", ".join(["_part int", "_o_n long"] + [f"_o_{c} {_sum_type(types[c])}" for c in sum_cols]
                       + [f"_a_{c} {types[c]}" for c in next_cols])
    offsets = df.sparkSession.createDataFrame(rows, schema)
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = ranked.join(F.broadcast(offsets), "_part")
    for c in sum_cols:
        out = out.withColumn(prefix + c, F.col(f"_o_{c}") + F.sum(c).over(within))
    if next_cols:
        follows = Window.partitionBy("_part").orderBy("_pos")
        last = F.lead(F.lit(1)).over(follows).isNull()
        out = out.withColumns({f"next_{c}": F.when(last, F.col(f"_a_{c}")).otherwise(F.lead(c).over(follows)) for c in next_cols})
    if row_number_col:
        out = out.withColumn(row_number_col, F.col("_o_n") + F.col("_pos") + F.lit(1))
    return out.drop("_part", "_pos", "_o_n", *[f"_o_{c}" for c in sum_cols], *[f"_a_{c}" for c in next_cols])


def global_row_number(df: DataFrame, order: list[Column], col: str = "row_no") -> DataFrame:
    """1-based row number in a global (total) order, distributed."""
    return running_totals(df, order, [], row_number_col=col)


#: Values strictly inside a bracket that one task puts in order at last.
BRACKET_VALUES = 8192
_ACCURACY = 10_000
_GRID = 64


def _value(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def _sql(x: float) -> str:
    return f"{x!r}D" if np.isfinite(x) else f"double('{x}')"


@dataclass
class OrderStatistic:
    """Neighbours of a quantile's place: values at its floor and ceiling."""

    n: int
    low: float | None
    high: float | None
    frac: float

    def value(self, most: float | None = None) -> float | None:
        """Linear interpolation, of values cut off at ``most`` if given."""
        if self.low is None:
            return None
        lo, hi = (self.low, self.high) if most is None else (min(self.low, most), min(self.high, most))
        return float(lo if lo == hi else lo + self.frac * (hi - lo))


_EPS = 2.0 / _ACCURACY


def value_columns(cols: Sequence[str]) -> list[Column]:
    """The columns as ``v0, v1, ...``: DOUBLE, NaN as NULL."""
    return [_value(c).alias(f"v{i}") for i, c in enumerate(cols)]


def first_brackets(n_cols: int, probs: Sequence[float]) -> list[Column]:
    """Aggregates of :func:`order_statistics`' first read, over ``v0, v1, ...``."""
    grid = ", ".join(f"{x!r}D" for p in probs for x in (max(0.0, p - _EPS), min(1.0, p + _EPS)))
    return [F.expr(e) for i in range(n_cols) for e in (
        f"count(v{i}) AS n{i}", f"min(v{i}) AS lo{i}", f"max(v{i}) AS hi{i}",
        f"percentile_approx(v{i}, array({grid}), {_ACCURACY}) AS q{i}")]


def _interpolated(p: float, n: int) -> float:
    return p * (n - 1)


def order_statistics(df: DataFrame, cols: Sequence[str], probs: Sequence[float], first: Row | None = None,
                     place: Callable[[float, int], float] = _interpolated) -> dict[tuple[str, float], OrderStatistic]:
    """The two order statistics of every (column, prob), NULL/NaN skipped.
    ``place(prob, n)`` is the wanted place among ``n`` values, from 0 (that of a
    linear quantile by default); ``first`` may bring the row of
    :func:`first_brackets`, read along with something else.

    One aggregate brackets every wanted place between two values of
    ``percentile_approx``. The next one counts what lies below a bracket, *at*
    each of its ends and strictly inside. A place among the equal values at an
    end is resolved by the counts, however many rows have that value (zeros of
    silent customers), and these rows leave the bracket. Up to
    ``BRACKET_VALUES`` values strictly inside are put in order by one task in
    that same aggregate; more are cut by a grid of their own percentiles and
    counted again. The driver gets counts, grid points and the results, never
    the values."""
    vals = df.select(*value_columns(cols))
    if first is None:
        first = vals.agg(*first_brackets(len(cols), probs)).first()
    out: dict[tuple[str, float], OrderStatistic] = {}
    todo: list[dict] = []
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        for k, p in enumerate(probs):
            pos = place(p, n) if n else 0.0
            out[c, p] = OrderStatistic(n, None, None, pos - np.floor(pos))
            if n:
                lo, hi = first[f"q{i}"][2 * k:2 * k + 2]
                # the approximation is off by n / _ACCURACY places at most
                todo.append({"at": out[c, p], "v": f"v{i}", "lo": lo, "hi": hi, "most": int(n * (2 * _EPS + 2 / _ACCURACY)) + 4,
                             "ranks": (int(np.floor(pos)), int(np.ceil(pos))), "all": (first[f"lo{i}"], first[f"hi{i}"], n)})
    steps = ", ".join(f"{g / _GRID}D" for g in range(_GRID + 1))
    while todo:
        aggs = []
        for j, t in enumerate(todo):
            v, lo, hi = t["v"], _sql(t["lo"]), _sql(t["hi"])
            within = f"{v} > {lo} AND {v} < {hi}"
            below, at_lo = f"count_if({v} < {lo})", f"count_if({v} = {lo})"
            aggs += [f"{below} AS b{j}", f"{at_lo} AS l{j}", f"count_if({within}) AS i{j}", f"count_if({v} = {hi} AND {v} > {lo}) AS h{j}"]
            if t["most"] <= BRACKET_VALUES:
                held = f"sort_array(collect_list(CASE WHEN {within} THEN {v} END))"
                aggs += [f"get({held}, CAST(greatest({r} - {below} - {at_lo}, -1) AS INT)) AS {e}{j}" for e, r in zip("xy", t["ranks"], strict=True)]
            else:
                aggs.append(f"percentile_approx(CASE WHEN {within} THEN {v} END, array({steps}), {_ACCURACY}) AS g{j}")
        got = vals.agg(*map(F.expr, aggs)).first().asDict()
        again = []
        for j, t in enumerate(todo):
            below, at_lo, inner, at_hi = (got[f"{e}{j}"] for e in "blih")
            if not below <= t["ranks"][0] <= t["ranks"][1] < below + at_lo + inner + at_hi:
                t["lo"], t["hi"], t["most"] = t["all"]  # the approximation missed: the whole range
                again.append(t)
                continue

            def known(rank: int, e: str) -> float | None:
                left = rank - below
                return t["lo"] if left < at_lo else t["hi"] if left >= at_lo + inner else got.get(f"{e}{j}")

            ends = known(t["ranks"][0], "x"), known(t["ranks"][1], "y")
            if None not in ends:
                t["at"].low, t["at"].high = ends
                continue
            if inner > BRACKET_VALUES:
                cuts = [t["lo"], t["lo"], *got[f"g{j}"], t["hi"], t["hi"]] if got.get(f"g{j}") else [t["lo"], t["hi"]]
                cells = [int(_GRID * min(max(r - below - at_lo, 0), inner - 1) / inner) for r in t["ranks"]]
                if f"g{j}" in got:
                    t["all"] = (t["lo"], t["hi"], inner + at_lo + at_hi)
                    t["lo"], t["hi"] = cuts[cells[0] + 1], cuts[cells[1] + 4]
            t["most"] = inner
            again.append(t)
        todo = again
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas' default) of several
    columns: one row per (column, prob) with ``(column, prob, n, value)``."""
    got = order_statistics(df, cols, probs)
    return df.sparkSession.createDataFrame(
        [(c, float(p), got[c, p].n, got[c, p].value()) for c in cols for p in probs],
        "column string, prob double, n long, value double")


def quantile_values(df: DataFrame, specs: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """``{alias: quantile(column, prob)}``."""
    got = order_statistics(df, sorted({c for c, _ in specs.values()}), sorted({p for _, p in specs.values()}))
    return {a: got[cp].value() for a, cp in specs.items()}


def quantile_row(df: DataFrame, specs: dict[str, tuple[str, float]]) -> DataFrame:
    """One-row frame ``{alias: quantile(column, prob)}``."""
    got = quantile_values(df, specs)
    return df.sparkSession.createDataFrame([tuple(got.values())], ", ".join(f"`{a}` double" for a in got))


#: Values of a group that its sketch holds exactly.
MEDIAN_SKETCH = 1024
#: Half width, as a share of the group, of a larger group's first bracket.
_NEAR = 0.02
#: Values of one group that a task puts in order at last.
GROUP_VALUES = 1 << 16
#: Groups whose state is broadcast (a count decides).
_FEW_GROUPS = 100_000


def sketch_bounds(sketch: str, n: str) -> tuple[Column, Column, Column, Column]:
    """From a KLL sketch of ``n`` values: the two middle values (NULL beyond
    ``MEDIAN_SKETCH``, where a sketch starts to drop values), and a bracket of
    the median. A rank just above one half names the upper middle value: the
    sketch rounds ``rank * n`` up, and ``n / (4 MEDIAN_SKETCH)`` is below one."""
    def at(rank: float) -> Column:
        return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(rank)))

    whole = F.col(n) <= MEDIAN_SKETCH
    return (F.when(whole, at(0.5)), F.when(whole, at(0.5 + 1 / (4 * MEDIAN_SKETCH))), at(0.5 - _NEAR), at(0.5 + _NEAR))


def bracket_medians(df: DataFrame, groups: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact medians ``(keys, median)`` of ``groups``: keys, ``n`` values, a
    bracket ``lo, hi`` thought to hold the median, extrema ``mn, mx``.

    Every round joins ``df`` with the open groups and counts, map-side combined,
    what lies below, at the ends of and strictly inside each bracket. A place at
    an end is resolved by counts. A bracket known to hold at most
    ``GROUP_VALUES`` values is put in order in the same round; a larger one is
    cut by a grid of its own sketch, a missed one starts again from the whole
    range. The state is one row a group, checkpointed, so no round depends on
    the ones before; a hot group's values are never in one task."""
    rows = df.select(*keys, _value(value).alias("_v")).where("_v is not null")
    state = materialize(groups.select(*keys, "n", "lo", "hi", "mn", "mx", F.col("n").alias("most")))
    done = None
    while True:
        left = state.count()
        if done is not None and not left:
            return done
        v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
        within = (v > lo) & (v < hi)
        direct = F.col("most") <= GROUP_VALUES
        grid = [g / _GRID for g in range(_GRID + 1)]
        j = rows.join(F.broadcast(state) if left <= _FEW_GROUPS else state, keys)
        counts = j.groupBy(*keys, "n", "lo", "hi", "mn", "mx", "most").agg(
            F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count_if(within).alias("inner"),
            F.count_if((v == hi) & (v > lo)).alias("at_hi"),
            F.sort_array(F.collect_list(F.when(within & direct, v))).alias("values"),
            F.kll_sketch_agg_double(F.when(within & ~direct, v), F.lit(MEDIAN_SKETCH)).alias("sketch"))
        first, last = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
        edge = F.col("below") + F.col("at_lo")

        def at(rank: Column) -> Column:
            return (F.when(rank < edge, lo).when(rank >= edge + F.col("inner"), hi)
                    .when(direct, F.get("values", (rank - edge).cast("int"))))

        held = (F.col("below") <= first) & (last < edge + F.col("inner") + F.col("at_hi"))
        cuts = F.when(~direct & (F.col("inner") > 0),
                      F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(g) for g in grid])))
        seen = materialize(counts.select(*keys, "n", "mn", "mx", "lo", "hi", "inner", held.alias("held"), cuts.alias("cuts"),
                                         F.when(held, (at(first) + at(last)) / 2).alias("median"),
                                         (first - edge).alias("r0"), (last - edge).alias("r1")))
        found = seen.where("median is not null").select(*keys, "median")
        done = found if done is None else done.unionByName(found)

        def cut(rank: str, side: int) -> Column:
            cell = F.floor(F.col(rank) * _GRID / F.col("inner")) + side
            return F.when((cell < 0) | (F.col(rank) < 0), F.col("lo")).when((cell > _GRID) | (F.col(rank) >= F.col("inner")), F.col("hi")) \
                .otherwise(F.get("cuts", F.greatest(F.least(cell, F.lit(_GRID)), F.lit(0)).cast("int")))

        state = materialize(seen.where("median is null").select(
            *keys, "n", F.when(F.col("held"), cut("r0", -2)).otherwise(F.col("mn")).alias("lo"),
            F.when(F.col("held"), cut("r1", 3)).otherwise(F.col("mx")).alias("hi"), "mn", "mx",
            F.when(F.col("held"), F.col("inner")).otherwise(F.col("n")).alias("most")))


def grouped_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median of every group, of any size, NULL/NaN skipped: one row per
    group with a value. No sort: a sketch per group, and for groups that are
    larger than it a count inside the bracket it gives."""
    rows = df.select(*keys, _value(value).alias("_v")).where("_v is not null")
    s = materialize(rows.groupBy(*keys).agg(
        F.count("_v").alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx"),
        F.kll_sketch_agg_double("_v", F.lit(MEDIAN_SKETCH)).alias("sketch")))
    low, high, lo, hi = sketch_bounds("sketch", "n")
    s = s.select(*keys, "n", "mn", "mx", ((low + high) / 2).alias(out), lo.alias("lo"), hi.alias("hi"))
    small = s.where(F.col("n") <= MEDIAN_SKETCH).select(*keys, out)
    large = s.where(F.col("n") > MEDIAN_SKETCH)
    return small.unionByName(bracket_medians(rows, large, keys, "_v").select(*keys, F.col("median").alias(out)))
