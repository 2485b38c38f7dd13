"""Reproducible draws from md5, independent of partitioning (no rand())."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def draw32(*parts: Column | str) -> Column:
    """Uniform integer in [0, 2^32) from the first eight hex digits of md5 over '|'-joined parts."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8), 16, 10).cast("long")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all shuffle partitions. With a given number AQE does not put small rows, each of which stands for many draws, into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def explode_subset(df: DataFrame, size: str, k: str, *parts: Column | str, out: str = "pos", at_once: int = 500_000) -> DataFrame:
    """One row per drawn position of a uniform k-subset of 1..size, without size and k: draw_subset in time linear in k.

    At most at_once rows and one subset leave a task at a time.
    """
    prefix = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    kept = [c for c in df.columns if c not in (size, k)]
    rows = df.select(*kept, F.col(size).cast("long").alias("_size"), F.col(k).cast("long").alias("_k"), prefix.alias("_prefix")).where("_k > 0")

    def floyd(n: int, m: int, start: str) -> set[int]:
        base, taken = md5(f"{start}|".encode()), set()
        for j in range(n - m + 1, n + 1):
            h = base.copy()
            h.update(b"%d" % j)
            t = int.from_bytes(h.digest()[:4], "big") % j + 1
            taken.add(j if t in taken else t)
        return taken

    def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            head, todo, held = b.select(kept), [], 0
            for i, (n, m, p) in enumerate(zip(*(b.column(c).to_pylist() for c in ("_size", "_k", "_prefix")), strict=True)):
                todo.append((i, np.fromiter(floyd(n, m, p), "int64")))
                held += m
                if held >= at_once or i == b.num_rows - 1:
                    at = np.repeat([j for j, _ in todo], [len(x) for _, x in todo])
                    pos = pa.array(np.concatenate([x for _, x in todo]))
                    yield pa.RecordBatch.from_arrays([*head.take(pa.array(at)).columns, pos], [*kept, out])
                    todo, held = [], 0

    schema = T.StructType([f for f in rows.schema.fields if f.name in kept] + [T.StructField(out, T.LongType())])
    return spread(rows).mapInArrow(drawn, schema)


def draw_subset(n: Column, k: Column, *parts: Column | str) -> Column:
    """Uniform k-subset of 1..n as an array, by Floyd's method: k draws, no shuffle of the population."""
    def step(acc: Column, j: Column) -> Column:
        t = F.pmod(draw32(*parts, j), j) + F.lit(1)
        return F.concat(acc, F.array(F.when(F.array_contains(acc, t), j).otherwise(t)))
    idx = F.sequence(n - k + 1, n)
    return F.when(k > 0, F.aggregate(idx, F.array().cast("array<bigint>"), step))
