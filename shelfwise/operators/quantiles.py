"""Exact quantiles and modes that never gather a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here bounded
sketches first narrow down, round by round, the values between which each wanted rank
must lie. Only those are counted exactly; everything below collapses into one count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import attach, hand_off

#: A group, or what is left of it between two edges, is ranked directly up to this size.
DIRECT_ROWS = 1_000_000
#: A sketch divides its values into this many steps, with an error of a tenth of a step.
SKETCH_STEPS = 1000
#: Steps that stay between the two edges around a rank: its own and one more on each side.
KEPT_STEPS = 4


def melt_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, v) with one row per present number; NaN counts as missing."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = df.select(*by, F.expr(f"stack({len(columns)}, {pairs}) as (metric, v)"))
    for key in by:
        long = long.where(F.col(key).isNotNull())
    return long.where("v is not null and not isnan(v)")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    direct_rows: int = DIRECT_ROWS,
    steps: int = SKETCH_STEPS,
) -> DataFrame:
    """One row per (by..., metric) with ``n`` and ``q0, q1, ...`` (linear interpolation).

    Two passes for groups up to ``direct_rows * steps / 4`` values; each further factor of
    ``steps / 4`` costs one more.
    """
    keys = [*by, "metric"]
    quoted = ", ".join(f"`{k}`" for k in keys)
    long = melt_numeric(df, columns, by)
    targets = _edges(long, keys, probs, direct_rows, steps)

    counted = (
        attach(long, targets, keys, "inner", stored=True)
        .where("hi is null or v <= hi")
        .selectExpr(*keys, "n", "i", "if(lo is null or v >= lo, v, null) as v")
        .groupBy(*keys, "n", "i", "v")
        .agg(F.count("*").alias("c"))
    )
    # Rows of one window: a small group, or the distinct values between two edges.
    ranked = counted.selectExpr(
        "*",
        f"sum(c) over (partition by {quoted}, i order by v asc nulls first "
        "rows between unbounded preceding and current row) as cum",
    )
    value = "if(v is null, cast(raise_error('quantile edges missed their rank') as double), v)"
    helpers, outputs = [], []
    for i, p in enumerate(probs):
        pos = f"({p!r}D * (n - 1))"
        helpers += [
            F.expr(f"min(if(i in (-1, {i}) and cum > {side}({pos}), {value}, null)) as {name}{i}")
            for name, side in (("lo", "floor"), ("hi", "ceil"))
        ]
        outputs.append(f"lo{i} + (hi{i} - lo{i}) * ({pos} - floor({pos})) as q{i}")
    return ranked.groupBy(*keys, "n").agg(*helpers).selectExpr(*keys, "n", *outputs)


def _edges(
    long: DataFrame, keys: Sequence[str], probs: Sequence[float], direct_rows: int, steps: int
) -> DataFrame:
    """(keys..., n, i, lo, hi), stored: values around the i-th probability's rank.

    A group small enough to be ranked as a whole has one row with i = -1 and no edges.
    """
    grid = ", ".join(f"{j / steps!r}D" for j in range(steps + 1))

    def sketch(value: str):
        return F.expr(f"percentile_approx({value}, array({grid}), {10 * steps}) as edge")

    def around(below: str, size: str) -> list[str]:
        low = f"greatest(0, floor((floor(p * (n - 1)) - {below}) / {size} * {steps}) - 1)"
        high = f"least({steps}, ceil((ceil(p * (n - 1)) + 1 - {below}) / {size} * {steps}) + 1)"
        return [f"edge[int({low})] as new_lo", f"edge[int({high})] as new_hi"]

    ranks = ", ".join(f"named_struct('i', {i}, 'p', {p!r}D)" for i, p in enumerate(probs))
    whole = "array(named_struct('i', -1, 'p', 0D))"
    targets = hand_off(
        long.groupBy(*keys)
        .agg(F.count("*").alias("n"), sketch("v"))
        .selectExpr(*keys, "n", "edge", f"inline(if(n > {direct_rows}, array({ranks}), {whole}))")
        .selectExpr(*keys, "n", "i", "p", "edge", *around("0", "n"))
        .selectExpr(
            *keys, "n", "i", "p",
            "if(i < 0, null, new_lo) as lo", "if(i < 0, null, new_hi) as hi",
            f"if(i < 0, 0, n * {KEPT_STEPS / steps}D) as size",
        ),
        "edges",
    )
    while True:
        if (targets.agg(F.max("size")).first()[0] or 0) <= direct_rows:
            return targets.select(*keys, "n", "i", "lo", "hi")
        wide = targets.where(F.col("size") > direct_rows)
        measured = (
            attach(long, wide.drop("size"), keys, "inner", stored=True)
            .where("v <= hi")
            .groupBy(*keys, "n", "i", "p", "lo", "hi")
            .agg(
                F.count_if(F.expr("v < lo")).alias("below"),
                F.count_if(F.expr("v >= lo")).alias("inside"),
                sketch("if(v >= lo, v, null)"),
            )
            .selectExpr(*keys, "n", "i", "p", "lo", "hi", "inside", *around("below", "inside"))
        )
        # Edges that no longer move stand on repeated values, which count as one each.
        narrower = measured.selectExpr(
            *keys, "n", "i", "p", "new_lo as lo", "new_hi as hi",
            f"if(new_lo = lo and new_hi = hi, 0, inside * {KEPT_STEPS / steps}D) as size",
        )
        targets = hand_off(targets.where(F.col("size") <= direct_rows).unionByName(narrower), "edges")


def exact_modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (by..., metric) with the most frequent text; ties take the smallest."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.select(*by, F.expr(f"stack({len(columns)}, {pairs}) as (metric, v)")).where("v is not null")
    for key in by:
        long = long.where(F.col(key).isNotNull())
    sizes = long.groupBy(*by, "metric", "v").agg(F.count("*").alias("c"))
    return sizes.groupBy(*by, "metric").agg(
        F.min_by("v", F.struct(-F.col("c"), F.col("v"))).alias("mode"), F.sum("c").alias("n")
    )


def wide_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Medians and present counts, one column pair per metric: ``med_x``, ``n_x``."""
    return _widen(exact_quantiles(df, columns, [0.5], by), columns, by, {"med": "q0", "n": "n"})


def wide_modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _widen(exact_modes(df, columns, by), columns, by, {"mode": "mode"})


def _widen(long: DataFrame, columns: Sequence[str], by: Sequence[str], parts: dict[str, str]) -> DataFrame:
    cells = [
        F.max(F.when(F.col("metric") == c, F.col(source))).alias(f"{prefix}_{c}")
        for c in columns
        for prefix, source in parts.items()
    ]
    return long.groupBy(*by).agg(*cells)
