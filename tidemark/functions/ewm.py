"""Recursive averages as window sums.

y_k = a*x_k + (1-a)*y_(k-1) with y_0 = x_0 unrolls to
y_k = b^k * sum(w_i * x_i * b^-i), b = 1-a, w_0 = 1, w_i = a,
one running sum per series. b^-i would overflow a double on very long histories,
so positions restart every BLOCK sessions and the end value of the block before is carried
in (anything older weighs less than 1e-13). A history may have any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 3000


def block_number(block: int = BLOCK) -> Column:
    """Number of the block of sessions a bar lies in, from its `pos`."""
    return F.floor(F.col("pos") / block)


def smooth_layers(specs: list[tuple[str, str, float, int]], key: str = "ticker", order: str | list[str] = "date", block: int = BLOCK,
                  part: Column | None = None) -> list[dict[str, Column]]:
    """Column layers that add smoothed series; a layer only reads columns of the layers before it.

    specs: (output, input, alpha, minimum observations). The frame must hold `pos` (0-based bar number of the key) and
    `_seen_<input>` (running non-null count, see `seen`). Nulls may only lead a series. part: the column that already
    holds the block number; when the frame's other windows are ordered by (part, order), all share one sort.
    """
    part = block_number(block) if part is None else part
    j = (F.col("pos") % block).cast("double")
    run = Window.partitionBy(key, part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    prev = Window.partitionBy(key).orderBy(part).rangeBetween(-1, -1)
    last = F.col("pos") % block == block - 1
    local = {f"_loc_{o}": _local(x, a, j, run) for o, x, a, _ in specs}
    ends = {f"_end_{o}": F.sum(F.when(last, F.col(f"_loc_{o}"))).over(prev) for o, _, _, _ in specs}
    zero = F.lit(0.0)
    out = {o: F.when(F.col(f"_seen_{x}") >= m, F.coalesce(F.col(f"_loc_{o}"), zero) + F.pow(F.lit(1.0 - a), j + 1.0) * F.coalesce(F.col(f"_end_{o}"), zero))
           for o, x, a, m in specs}
    return [local, ends, out]


def _local(x: str, a: float, j: Column, run) -> Column:
    b = F.lit(1.0 - a)
    weight = F.when(F.col(f"_seen_{x}") == 1, F.lit(1.0)).otherwise(F.lit(a))
    return F.pow(b, j) * F.sum(weight * F.col(x) * F.pow(b, -j)).over(run)


def seen(x: str, expr: Column | None = None, key: str = "ticker", order: str | list[str] = "date") -> dict[str, Column]:
    """Running non-null count of a column, or of the expression that defines it in the same layer."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return {f"_seen_{x}": F.count(F.col(x) if expr is None else expr).over(w)}


def apply_layers(df: DataFrame, *families: list[dict[str, Column]]) -> DataFrame:
    """Add the layers of several column families side by side: one window pass per depth, helpers dropped at the end."""
    made: dict[str, None] = {}
    for k in range(max(len(f) for f in families)):
        layer = {n: c for f in families if k < len(f) for n, c in f[k].items()}
        made |= dict.fromkeys(layer)
        df = df.withColumns(layer)
    return df.drop(*[n for n in made if n.startswith("_")])


def smooth(df: DataFrame, key: str, order: str, specs: list[tuple[str, str, float, int]], block: int = BLOCK) -> DataFrame:
    """Add smoothed columns to a frame that holds `pos`."""
    first = {}
    for x in sorted({x for _, x, _, _ in specs}):
        first |= seen(x, None, key, order)
    return apply_layers(df, [first, *smooth_layers(specs, key, order, block)])
