"""Near-duplicate vectors of equal label by collision-counting projections.

Vectors are scaled to length one and projected on many random directions (fixed seed). On the line of one projection a pair collides
when it lies in one window. Directions are taken in groups; in every group the windows of all its directions form a cell, and pairs
that share a cell of any group are candidates. The number of directions per group follows the logarithm of the largest label's size,
so that a vector meets about one stranger per group at every size; the number of groups follows from the wanted recall at the
threshold itself (closer pairs have more). A candidate pair is taken up in the first group whose cell it shares, so it counts once.
Its collisions are then counted over COUNTED projections with windows centred on the query vector; a pair below the count that a pair
at the threshold reaches with near certainty is dropped, the others are verified by their cosine in double precision.

Equal vectors of a label form one class with a multiplicity, so copies are never compared. Large cells are cut into blocks that meet
pairwise in different tasks; a task keeps sums of links and the local components, not pairs. Null, empty, zero and non-finite
vectors, vectors with null components, and null labels link with nothing. Vectors of different length are never compared. Repeated
rows are vectors of their own; rows of a null id are linked like others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix
from tidemark.llm.components import connected_components
from tidemark.session import materialise

SEED = 20_11
WIDTH = 2.0       # cell width in standard deviations of a random vector's projection
COUNTED = 64
BLOCK_ROWS = 1024
ROWS_PER_TASK = 20_000


@dataclass(frozen=True)
class Projections:
    """Group size, number of groups, window and count for one threshold, recall and label size."""
    threshold: float
    size: int
    groups: int
    window: float
    least: int

    @staticmethod
    def plan(threshold: float, recall: float, rows: int) -> Projections:
        gap = sqrt(max(2 - 2 * threshold, 1e-12))  # distance at the threshold
        near = 1 - gap * sqrt(2 / pi) / WIDTH * (1 - exp(-(WIDTH / gap) ** 2 / 2)) - 2 * (1 - 0.5 * (1 + erf(WIDTH / gap / sqrt(2))))
        far_gap = sqrt(2)
        far = erf(WIDTH / far_gap / sqrt(2)) - far_gap * sqrt(2 / pi) / WIDTH * (1 - exp(-(WIDTH / far_gap) ** 2 / 2))
        size = max(1, ceil(log(max(rows, 2)) / -log(far)))
        groups = max(1, ceil(log(1 - recall) / log(1 - max(near, 0.05) ** size)))
        window = 1.2816 * gap  # eight of ten projections of a pair at the threshold collide
        return Projections(threshold, size, groups, window, int(0.8 * COUNTED - 5 * sqrt(0.16 * COUNTED)))

    def directions(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([SEED, dim])
        d = rng.standard_normal((dim, max(self.size * self.groups, COUNTED)))
        d *= sqrt(dim) / np.linalg.norm(d, axis=0)
        return d, rng.random(d.shape[1]) * WIDTH

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells: one 64-bit number per vector and group, the counted projections)."""
        d, shift = self.directions(unit.shape[1])
        p = unit @ d
        used = self.size * self.groups
        cell = np.floor((p[:, :used] + shift[:used]) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), self.groups, self.size)
        acc = np.tile(mix(np.arange(self.groups, dtype=np.uint64) + np.uint64(unit.shape[1] << 32)), (len(unit), 1))
        for i in range(self.size):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, i])
        return acc, p[:, :COUNTED]


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(vectors: pd.Series) -> Iterator[np.ndarray]:
    size = vectors.map(len).to_numpy()
    for n in np.unique(size):
        yield np.flatnonzero(size == n)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable row of every row."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_links(rows: pd.DataFrame, plan: Projections) -> pd.DataFrame:
    """Links of the cells and blocks in one task: per class the multiplicities it links with, and local components as (cid, root)."""
    found = []
    for own in _by_length(rows["e"]):
        part = rows.iloc[own]
        part = part.sort_values(["cell", "lo", "hi"], kind="stable").reset_index(drop=True)
        unit = _unit(part["e"])
        cells, counted = plan.project(unit)
        label = part["label"].to_numpy()
        group = part["grp"].to_numpy()
        side, lo, hi = part["block"].to_numpy(), part["lo"].to_numpy(), part["hi"].to_numpy()
        key = part[["cell", "lo", "hi"]].to_numpy()
        start = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(part)]])
        run = np.repeat(np.diff(start), np.diff(start))
        end = np.repeat(start[1:], np.diff(start))
        pairs_a, pairs_b = [], []

        def test(i: np.ndarray, j: np.ndarray) -> None:
            ok = (label[i] == label[j]) & ((lo[i] == hi[i]) | (side[i] != side[j]))
            i, j = i[ok], j[ok]
            for g in range(int(group[i].max()) if len(i) else 0):  # taken up by an earlier group
                if not len(i):
                    return
                ok = (cells[i, g] != cells[j, g]) | (group[i] <= g)
                i, j = i[ok], j[ok]
            for at in range(0, len(i), 200_000):
                x, y = i[at:at + 200_000], j[at:at + 200_000]
                ok = (np.abs(counted[x] - counted[y]) <= plan.window).sum(1) >= plan.least
                x, y = x[ok], y[ok]
                ok = np.einsum("ij,ij->i", unit[x], unit[y]) >= plan.threshold
                pairs_a.append(x[ok])
                pairs_b.append(y[ok])

        small = run <= 64
        for step in range(1, int(run[small].max()) if small.any() else 0):
            i = np.flatnonzero(small & (np.arange(len(part)) + step < end))
            test(i, i + step)
        for s, e in zip(start[:-1], start[1:], strict=True):
            if e - s > 64:
                for i in range(s, e - 1):
                    j = np.arange(i + 1, e)
                    test(np.full(len(j), i), j)
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (pairs_a, pairs_b))
        if not len(a):
            continue
        cid, mult = part["cid"].to_numpy(), part["mult"].to_numpy()
        links = np.bincount(a, mult[b], len(part)) + np.bincount(b, mult[a], len(part))
        code, first = np.unique(cid, return_inverse=True)
        root = code[_forest(len(code), first[a], first[b])][first]
        hit = links > 0
        found.append(pd.DataFrame({"cid": cid[hit], "links": links[hit].astype(np.int64), "root": root[hit]}))
    out = pd.concat(found) if found else pd.DataFrame({"cid": [], "links": [], "root": []})
    return out.groupby(["cid", "root"], as_index=False)["links"].sum()[["cid", "links", "root"]].astype(np.int64)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    e = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    v = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), e.alias("e"))
    good = (F.col("label").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("e", lambda x: x != 0))
    v = v.withColumn("cid", F.when(good, F.xxhash64("label", "e")))
    classes = materialise(v.where("cid is not null").groupBy("cid").agg(
        F.first("label").alias("label"), F.first("e").alias("e"), F.count("*").alias("mult"), F.min("vec_id").alias("vec_id")), "vector_classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    plan = Projections.plan(threshold, recall, largest)

    @F.pandas_udf("array<long>")
    def cells_of(vecs: pd.Series) -> pd.Series:
        out = np.empty(len(vecs), object)
        for own in _by_length(vecs):
            for at in np.array_split(own, -(-len(own) // 4096)):
                cell, _ = plan.project(_unit(vecs.iloc[at]))
                for i, c in zip(at, cell.view(np.int64), strict=True):
                    out[i] = c
        return pd.Series(out)

    cells = materialise(classes.select("cid", "label", F.posexplode(cells_of("e")).alias("grp", "c")).select(
        "cid", F.col("grp"), F.xxhash64("label", "c", "grp").alias("cell")), "cells")
    many = cells.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK_ROWS).cast("int")
    met = cells.join(many, "cell").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("cell", "grp", "cid", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    met = materialise(met, "cell_members")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), met.count() // ROWS_PER_TASK + 1)
    met = met.join(classes.select("cid", "label", "e", "mult"), "cid").withColumn("task", F.pmod(F.xxhash64("cell", "lo", "hi"), F.lit(tasks)))
    links = materialise(met.groupBy("task").applyInPandas(lambda d: _block_links(d, plan), "cid long, links long, root long"), "block_links")

    root = connected_components(links, "cid", "root").withColumnsRenamed({"node": "cid", "root": "comp"})
    by_class = classes.select("cid", "mult", "vec_id").join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(root, "cid", "left")
    by_class = by_class.select("cid", "vec_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("comp", "cid").alias("comp"))
    head = by_class.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    by_class = materialise(by_class.select("cid", "n_links", "comp").join(head, "comp"), "class_links")
    linked = v.where("cid is not null").select("vec_id", "cid").join(by_class, "cid").select("vec_id", "n_links", "component_id")
    alone = v.where("cid is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
