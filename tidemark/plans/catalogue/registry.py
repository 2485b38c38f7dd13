"""Query registry and the helpers that keep both sides in the same report form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.expr import tidy
from tidemark.plans.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6, **per: int):
    """Register fn(workspace) under a name; doubles are rounded to `digits`."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(Workspace(spark, sf_dir)), digits, **per)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def num(col: str, digits: int = 6, expr: str | None = None) -> str:
    e = expr or col
    return f"case when abs({e}) < {0.5 * 10.0 ** -digits:.12f}e0 then 0e0 else round(({e})::double, {digits}) end as {col}"


def report(frm: str, keys: str = "", nums: str = "", ints: str = "", digits: int = 6, ctes: str = "", **per: int) -> str:
    """select keys, rounded doubles and bigints from a relation."""
    cols = keys.split() + [num(c, per.get(c, digits)) for c in nums.split()] + [f"cast({c} as bigint) as {c}" for c in ints.split()]
    return f"{ctes}\nselect {', '.join(cols)} from {frm}"
