"""Shortest-pack-first packing over the length histogram, with documents cut to fill what stays open.

A sequence holds at most `capacity` tokens (a power of two) and is padded to it, except when its length is a power of two.

Every document gives its whole capacity-sized pieces, which stand alone, and a tail. Spark counts the tails per length, a table of
at most capacity - 1 rows. On it the driver places lengths longest first, always into the packs that are filled least: packs of equal
pattern are one numbered range with a count, and a placement moves as many of them as it fills to their next pattern. Each placement
is an entry (length, first rank, number, first sequence, offset), so a tail finds its place by its length and its rank within it.

Packs that are left partly filled would be padded. The least filled ones are therefore taken apart, until their tokens are enough to
fill all the others; their tokens, in order of the packs, are cut into the open rooms one after another, and what is left over (less
than one pack) into sequences whose sizes are its binary digits. Every cut follows by arithmetic from the position of a token in the
order of the packs taken apart and a table of rooms by size, so no list of cuts exists anywhere. Nothing is padded in the end.

Encoded ids are stored once, with the rank of every tail within its task and length; ranks over all tasks add a running count per
task. Only documents with a tail in a pack that is taken apart need their ids again, for the checksums of their cuts.

Null and empty texts are the end id alone. Very long texts are cut. Repeated rows and ids (also null ids) are packed as rows of their
own; ties in length are broken by the order in which tasks read them, as stored. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import ranges, spaced_chunks
from tidemark.llm.library import encoded
from tidemark.session import materialise

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
STORED = "part int, row long, doc_id long, n long, tail int, tail_rank long, whole long, whole_rank long, crcs array<long>, ids binary"


@dataclass
class Plan:
    """Where tails go. Arrays of the placements, sorted by (length, rank); packs taken apart by first sequence; rooms by token order."""
    capacity: int
    key: np.ndarray  # length << 40 | first rank
    sequence: np.ndarray
    offset: np.ndarray
    apart: np.ndarray  # first sequence, number of packs, tokens of each, tokens in the packs before
    rooms: np.ndarray  # first token, size, number of rooms, first sequence, offset
    sequences: int
    cut_lengths: list[int] = field(default_factory=list)  # lengths with a tail in a pack taken apart

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset, first token in the order of the packs taken apart or -1) of tails."""
        want = length.astype(np.int64) << 40 | rank.astype(np.int64)
        at = np.searchsorted(self.key, want, "right") - 1
        sequence, offset = self.sequence[at] + (want - self.key[at]), self.offset[at]
        token = np.full(len(want), -1, np.int64)
        if len(self.apart):
            first, number, tokens, before = self.apart.T
            g = np.searchsorted(first, sequence, "right") - 1
            inside = (g >= 0) & (sequence < first[g] + number[g])
            token[inside] = (before[g] + (sequence - first[g]) * tokens[g] + offset)[inside]
        return sequence, offset, token

    def cuts(self, token: int, length: int) -> list[tuple[int, int, int, int]]:
        """(start within the tail, length, sequence, offset) of a tail whose first token has this number."""
        out, at, end = [], token, token + length
        first, size, number, sequence, offset = self.rooms.T
        while at < end:
            g = int(np.searchsorted(first, at, "right")) - 1
            k, into = divmod(at - int(first[g]), int(size[g]))
            n = min(end - at, int(size[g]) - into)
            out.append((at - token, n, int(sequence[g]) + k, int(offset[g]) + into))
            at += n
        return out


def shortest_pack_first(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """(placements: length, first rank, number, first sequence, offset; packs: tokens, first sequence, number)."""
    placed: list[tuple[int, int, int, int, int]] = []
    packs: list[tuple[int, int, int]] = []  # a heap: least filled first
    sequences = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not packs or packs[0][0] + length > capacity:
                new = -(-left // (capacity // length))
                heapq.heappush(packs, (0, sequences, new))
                sequences += new
            tokens, first, number = heapq.heappop(packs)
            used = min(number, left)
            placed.append((length, rank, used, first, tokens))
            heapq.heappush(packs, (tokens + length, first, used))
            if used < number:
                heapq.heappush(packs, (tokens, first + used, number - used))
            rank, left = rank + used, left - used
    return placed, sorted(packs)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Shortest-pack-first, then the least filled packs are taken apart until they fill all others."""
    placed, packs = shortest_pack_first(counts, capacity)
    open_packs = [p for p in packs if p[0] & (p[0] - 1)]  # a power of two needs no padding
    needed, supply = sum((capacity - t) * n for t, _, n in open_packs), 0
    apart: list[tuple[int, int, int, int]] = []
    rest: list[tuple[int, int, int]] = []
    for tokens, first, number in open_packs:
        # with k packs apart: supply + k * tokens >= needed - k * (capacity - tokens)
        k = min(number, max(0, -(-(needed - supply) // capacity)))
        if k:
            apart.append((first, k, tokens, supply))
            supply, needed = supply + k * tokens, needed - k * (capacity - tokens)
        if k < number:
            rest.append((tokens, first + k, number - k))
    rooms, at = [], 0
    for tokens, first, number in rest:
        rooms.append((at, capacity - tokens, number, first, tokens))
        at += (capacity - tokens) * number
    sequences, surplus = sum(n for _, _, n in packs), supply - at
    for bit in range(surplus.bit_length() - 1, -1, -1):
        if surplus >> bit & 1:
            rooms.append((at, 1 << bit, 1, sequences, 0))
            at, sequences = at + (1 << bit), sequences + 1
    spans = sorted((first, first + k) for first, k, _, _ in apart)
    lengths = {length for length, _, n, first, _ in placed if any(a < first + n and first < b for a, b in spans)}
    table = np.array(sorted((length << 40 | rank, first, offset) for length, rank, _, first, offset in placed), np.int64).reshape(-1, 3)
    return Plan(capacity, table[:, 0], table[:, 1], table[:, 2], np.array(sorted(apart), np.int64).reshape(-1, 4),
                np.array(rooms, np.int64).reshape(-1, 5), sequences, sorted(lengths))


def store_ids(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Ids of every document, checksums of its capacity-sized pieces and tail, and its ranks within its task."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row, whole_rank = TaskContext.get().partitionId(), 0, 0
        tails: Counter[int] = Counter()
        names: list[pd.Series] = []

        def texts() -> Iterator[pd.Series]:
            for b in batches:
                names.append(b["doc_id"])
                yield b["text"]

        end = np.array([end_id], np.int32)
        for at, rows in encoded(texts(), tokenizer, spaced_chunks, " "):
            out: dict[str, list] = {c.split()[0]: [] for c in STORED.split(", ")}
            for d, ids in zip(names[-1].iloc[at:at + len(rows)], rows, strict=True):
                raw = np.concatenate([ids, end]).astype("<u4")
                whole, tail = divmod(len(raw), capacity)
                values = (part, row, None if pd.isna(d) else int(d), len(raw), tail, tails[tail], whole, whole_rank,
                          [zlib.crc32(raw[a:a + capacity].tobytes()) for a in range(0, len(raw), capacity)], raw[whole * capacity:].astype("<u2" if raw.max() < 1 << 16 else "<u4").tobytes())
                for column, v in zip(out.values(), values, strict=True):
                    column.append(v)
                tails[tail] += 1
                row, whole_rank = row + 1, whole_rank + whole
            if rows:
                frame = pd.DataFrame(out)
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame
            else:
                names.clear()

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialise(d.mapInPandas(write, STORED), "packing_ids")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    stored = store_ids(docs, tokenizer, end_id, capacity, id_col, text_col)
    per_part = materialise(stored.groupBy("part", "tail").agg(F.count("*").alias("number"), F.sum("whole").alias("wholes")), "packing_counts")
    counts = {r["tail"]: r["number"] for r in per_part.where("tail > 0").groupBy("tail").agg(F.sum("number").alias("number")).collect()}  # below `capacity` rows
    plan = make_plan(counts, capacity)

    before = lambda value, w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tail_base = per_part.select("part", "tail", before("number", Window.partitionBy("tail").orderBy("part")).alias("tail_base"))
    parts = per_part.groupBy("part").agg(F.sum("wholes").alias("wholes"))  # one row a task
    whole_base = parts.select("part", before("wholes", Window.orderBy("part")).alias("whole_base"))
    ranked = (stored.select("part", "row", "doc_id", "n", "tail", "tail_rank", "whole", "whole_rank", "crcs").join(tail_base, ["part", "tail"]).join(whole_base, "part")
              .withColumn("tail_rank", F.col("tail_rank") + F.col("tail_base")).withColumn("whole_rank", F.col("whole_rank") + F.col("whole_base")))

    def natural(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, tail, whole = (b[c].to_numpy(np.int64) for c in ("n", "tail", "whole"))
            doc, here = np.arange(len(b)), np.flatnonzero(tail > 0)
            sequence, offset, token = plan.place(tail[here], b["tail_rank"].to_numpy(np.int64)[here])
            kept = here[token < 0]
            crcs = np.array([c for x in b["crcs"] for c in x], np.int64)
            at = np.cumsum(whole + (tail > 0)) - (whole + (tail > 0))
            own, k = np.repeat(doc, whole), ranges(np.zeros(len(b), np.int64), whole)
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64").take(np.concatenate([own, kept])).array,
                "start": np.concatenate([k * capacity, whole[kept] * capacity]), "length": np.concatenate([np.full(len(own), capacity), tail[kept]]),
                "ids_crc32": np.concatenate([crcs[at[own] + k], crcs[at[kept] + whole[kept]]]), "doc_tokens": np.concatenate([n[own], n[kept]]),
                "sequence_id": np.concatenate([plan.sequences + b["whole_rank"].to_numpy(np.int64)[own] + k, sequence[token < 0]]),
                "offset": np.concatenate([np.zeros(len(own), np.int64), offset[token < 0]])})

    def taken_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tail, whole = b["tail"].to_numpy(np.int64), b["whole"].to_numpy(np.int64)
            _, _, token = plan.place(tail, b["tail_rank"].to_numpy(np.int64))
            out = []
            for i in np.flatnonzero(token >= 0):
                raw, t = b["ids"].iloc[i], int(tail[i])
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * t else "<u4").astype("<u4")
                base = int(whole[i]) * capacity
                out += [(b["doc_id"].iloc[i], base + a, k, zlib.crc32(ids[a:a + k].tobytes()), b["n"].iloc[i], s, o) for a, k, s, o in plan.cuts(int(token[i]), t)]
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    pieces = ranked.mapInPandas(natural, PIECES)
    if not plan.cut_lengths:
        return pieces
    cut = F.col("tail").isin(plan.cut_lengths)
    ids = stored.where(cut).select("part", "row", "ids")
    again = ranked.where(cut).select("part", "row", "doc_id", "n", "tail", "tail_rank", "whole").join(ids, ["part", "row"])
    return pieces.union(again.mapInPandas(taken_apart, PIECES))
