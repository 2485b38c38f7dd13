"""Packing token pieces into sequences of fixed capacity by bin completion.

Only lengths matter, and there are at most `capacity` different ones: Spark counts the pieces per length, the counts (a table whose
size does not grow with the data) are packed into patterns with multiplicities, and every piece finds its place by its length and
its rank within the length. So all pieces share one global packing, and no task or driver ever holds the pieces.

The packing starts with best fit decreasing as incumbent. If that is above the lower bound, bin completion runs: around the largest length left, undominated fillings are enumerated largest first (equal sums: the one of fewer pieces dominates),
each is used as often as its lengths allow, and a branch ends when its waste exceeds what the incumbent leaves. The search visits a
bounded number of fillings; the incumbent stays when nothing better is found.

Null and empty texts are one piece of the end id. Longer documents are cut into whole pieces of the capacity. Repeated rows and
repeated ids are packed as rows of their own. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import spaceless_chunks
from tidemark.llm.library import encoded
from tidemark.session import materialise

Pattern = tuple[tuple[int, ...], int]  # lengths of one sequence, number of sequences
FILL_NODES = 400
BRANCH_NODES = 40_000
BRANCHES = 3


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit on counted lengths: equal bins are one group that is split when only part of it is filled."""
    open_bins: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_bins[room].append([lengths, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_right(rooms, length - 1)
            if i == len(rooms):
                each = min(capacity // length, left)
                n = left // each
                put(capacity - each * length, (length,) * each, n)
                left -= each * n
                continue
            room = rooms[i]
            lengths, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[i]
            each = min(room // length, left)
            used = min(n, left // each)
            if n > used:
                put(room, lengths, n - used)
            put(room - each * length, lengths + (length,) * each, used)
            left -= each * used
    return [(lengths, n) for group in open_bins.values() for lengths, n in group]


def fillings(room: int, left: dict[int, int], lengths: list[int], most: int, nodes: int = FILL_NODES) -> list[tuple[int, ...]]:
    """Undominated fillings of a room, least waste first. lengths: ascending, those with pieces left."""
    best: dict[int, tuple[int, ...]] = {}
    budget = nodes

    def note(chosen: tuple[int, ...], rest: int) -> None:
        if rest not in best or len(chosen) < len(best[rest]):
            best[rest] = chosen

    def search(rest: int, chosen: tuple[int, ...], below: int) -> None:
        nonlocal budget
        budget -= 1
        if budget <= 0:
            note(chosen, rest)
            return
        if rest and left.get(rest, 0) > chosen.count(rest):
            note((*chosen, rest), 0)
            return
        i = bisect_right(lengths, min(rest, below)) - 1
        if i < 0 or rest < lengths[0]:
            note(chosen, rest)
            return
        alone = True
        while i >= 0 and budget > 0 and 0 not in best:
            x = lengths[i]
            if left.get(x, 0) > chosen.count(x):
                alone = False
                search(rest - x, (*chosen, x), x)
            i -= 1
        if alone:
            note(chosen, rest)

    search(room, (), room)
    return [best[w] for w in sorted(best)[:most]]


def bin_completion(counts: dict[int, int], capacity: int, limit: int, nodes: int = BRANCH_NODES) -> list[Pattern] | None:
    """A packing into fewer than `limit` bins, or None if the bounded search finds none."""
    allowed = (limit - 1) * capacity - sum(k * n for k, n in counts.items())
    if allowed < 0:
        return None
    budget = nodes
    start = {k: n for k, n in counts.items() if n}
    stack: list[tuple[dict[int, int], list[int], int, list[Pattern]]] = [(start, sorted(start), 0, [])]
    while stack and budget > 0:
        left, lengths, waste, done = stack.pop()
        while lengths:
            budget -= 1
            top = lengths[-1]
            left[top] -= 1
            options = fillings(capacity - top, left, lengths, BRANCHES)
            left[top] += 1
            ways = []
            for f in options:
                bin_ = (top, *f)
                need = Counter(bin_)
                lost = capacity - sum(bin_)
                n = min(left[k] // c for k, c in need.items())
                if lost:
                    n = min(n, (allowed - waste) // lost)
                if n > 0:
                    ways.append((bin_, need, n, waste + lost * n))
            if not ways:
                break
            for bin_, need, n, w in ways[:0:-1]:
                if len(stack) < 64:
                    other = dict(left)
                    for k, c in need.items():
                        other[k] -= c * n
                    stack.append((other, [k for k in lengths if other[k]], w, [*done, (bin_, n)]))
            bin_, need, n, waste = ways[0]
            for k, c in need.items():
                left[k] -= c * n
            lengths = [k for k in lengths if left[k]]
            done = [*done, (bin_, n)]
        else:
            return done
    return None


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for every cut a, pieces above half stand alone and those from a on only fit beside pieces of at most capacity - a."""
    k = np.array(sorted(counts), np.int64)
    n = np.array([counts[x] for x in k], np.int64)
    total, number = np.concatenate([[0], np.cumsum(k * n)]), np.concatenate([[0], np.cumsum(n)])
    upto = lambda x: np.searchsorted(k, x, "right")  # noqa: E731  lengths of at most x
    cut = np.concatenate([[0], k[k * 2 <= capacity]])
    half, top, low = upto(capacity // 2), upto(capacity - cut), np.searchsorted(k, cut, "left")
    alone = number[-1] - number[half]
    room = (number[top] - number[half]) * capacity - (total[top] - total[half])
    return int(alone + max(0, (-(-(total[half] - total[low] - room) // capacity)).max(initial=0)))


def pack_counts(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use every counted piece exactly once, in as few bins as the search finds."""
    plan = best_fit_decreasing(counts, capacity)
    bins, bound = sum(n for _, n in plan), lower_bound(counts, capacity)
    while bins > bound:
        better = bin_completion(dict(counts), capacity, bins)
        if better is None:
            break
        plan, bins = better, sum(n for _, n in better)
    return plan


def places(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """Per length, ascending ranges of ranks: key (length << 40 | first rank), first sequence and offset of the range."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, n in plan:
        at = 0
        for k in lengths:
            rows.append((k << 40 | used[k], sequence, at))
            used[k] += n
            at += k
        sequence += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 3)
    return {"key": a[:, 0], "sequence": a[:, 1], "offset": a[:, 2]}


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        end, out = np.array([end_id], np.int32), []
        for _, rows in encoded(texts, tokenizer, spaceless_chunks, ""):
            for ids in rows:
                raw = np.concatenate([ids, end]).astype("<u4")
                out.append([{"piece": i, "start": a, "length": min(capacity, len(raw) - a), "ids_crc32": zlib.crc32(raw[a:a + capacity].tobytes())}
                            for i, a in enumerate(range(0, len(raw), capacity))])
            if not rows:
                yield pd.Series(out, dtype=object)
                out = []

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.inline(pieces(F.col(f"`{text_col}`").cast("string"))))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col)
    pieces = materialise(cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = places(pack_counts(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        want = (length.to_numpy(np.int64) << 40) | rank.to_numpy(np.int64)
        i = np.searchsorted(plan["key"], want, "right") - 1
        return pd.DataFrame({"sequence_id": plan["sequence"][i] + (want - plan["key"][i]), "offset": plan["offset"][i]})

    by = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(by), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("local", local).join(base, ["length", "salt"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", placed("length", F.col("base") + F.col("local")).alias("p")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "p.*")
