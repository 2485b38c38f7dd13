"""Byte-level BPE from a rank file, encoded in length-bucketed padded numpy matrices and decoded from the ids.

Every match of the split pattern is a row of byte ids. Rows of similar length share one padded matrix; in every round each row
merges its leftmost pair of minimum rank, found in a matrix of pair ranks that is looked up in a hash table and updated only beside
the merge; finished rows leave the matrix. Rows longer than LONG would cost the square of their length there, so they go through an
ordered heap with the same rule. Distinct chunks are merged once per worker.

Null and empty texts have no ids and decode to empty bytes; repeated rows get equal ids; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import ChunkTable, slices, spaced_chunks

LONG = 256
NONE = np.int32(2**31 - 1)


def read_ranks(lines: list[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class PairTable:
    """(left id, right id) -> rank of the joined token: open addressing, probed for whole arrays at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        self.shift = np.uint64(64 - max(4, int(len(key) * 3).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.key, self.value = np.full(size, 2**64 - 1, np.uint64), np.full(size, NONE, np.int32)
        slot, todo, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(todo):
            self.probes += 1
            free = self.key[slot[todo]] == 2**64 - 1
            asked = todo[free]
            _, first = np.unique(slot[asked], return_index=True)
            won = asked[first]
            self.key[slot[won]], self.value[slot[won]] = key[won], value[won]
            todo = todo[~np.isin(todo, won)]
            slot[todo] = (slot[todo] + 1) % size

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where the two do not join; negative ids (padding) never do."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = left.ravel()[todo].astype(np.uint64) << np.uint64(32) | right.ravel()[todo].astype(np.uint64)
        slot, flat, size = self._slot(key), out.ravel(), len(self.key)
        for _ in range(self.probes):
            if not len(todo):
                break
            at = self.key[slot]
            hit = at == key
            flat[todo[hit]] = self.value[slot[hit]]
            on = ~hit & (at != 2**64 - 1)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) % size
        return flat.reshape(left.shape)


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pairs = PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.ranks, self.token = ranks, {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.known: dict[str, np.ndarray] = {}

    def merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of byte strings of similar length, merged together in one matrix."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(rows)
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        width = int(size.max())
        ids = np.full((len(rows), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((len(rows), width), NONE, np.int32)
        rank[:, :-1] = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        who = np.arange(len(rows))
        while len(who):
            at = rank.argmin(axis=1)  # the first of the smallest
            row = np.arange(len(who))
            low = rank[row, at]
            done = low == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    out[who[r]] = ids[r][ids[r] >= 0].copy()
                on = ~done
                who, ids, rank, at, low, row = who[on], ids[on], rank[on], at[on], low[on], np.arange(int(on.sum()))
                if not len(who):
                    break
            width = ids.shape[1]
            source = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            ids[row, at] = low
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            after = np.where(at + 1 < ids.shape[1], ids[row, np.minimum(at + 1, ids.shape[1] - 1)], -1)
            before = np.where(at > 0, ids[row, np.maximum(at - 1, 0)], -1)
            rank[row, at] = self.pairs.rank(low, after)
            left = at > 0
            rank[row[left], at[left] - 1] = self.pairs.rank(before[left], low[left])
            rank[:, -1] = NONE
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same rule for one long piece by a heap of (rank, position)."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i) for i, r in enumerate(self.pairs.rank(ids[:-1], ids[1:]).tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, alive, cache = ids.tolist(), [True] * n, {}

        def rank(a: int, b: int) -> int:
            key = (ids[a], ids[b])
            if key not in cache:
                cache[key] = int(self.pairs.rank(np.array([key[0]]), np.array([key[1]]))[0])
            return cache[key]

        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j < 0 or rank(i, j) != r:
                continue
            ids[i], alive[j], right[i] = r, False, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (x := rank(a, b)) != NONE:
                    heapq.heappush(heap, (x, a))
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece; one that is itself a token is that token."""
        whole = [self.ranks.get(p) for p in pieces]
        out = [np.empty(0, np.int32) if r is None else np.array([r], np.int32) for r in whole]
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bucket = np.where([r is not None for r in whole], -2, np.where(size > LONG, -1, np.maximum(size - 1, 0) // 4))
        for b in np.unique(bucket):
            own = np.flatnonzero(bucket == b)
            if b == -2:
                continue
            if b == -1:
                for i in own:
                    out[i] = self.merge_long(pieces[i])
                continue
            for part in np.array_split(own, -(-len(own) // 50_000)):
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks; every match of the pattern is merged on its own, each distinct one once."""
        if len(self.known) > 300_000:
            self.known.clear()
        split = [self.find(c) for c in chunks]
        new = list({p for s in split for p in s if p not in self.known})
        self.known.update(zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new]), strict=True))
        size = np.fromiter((sum(len(self.known[p]) for p in s) for s in split), np.int64, len(split))
        flat = [self.known[p] for s in split for p in s]
        return np.concatenate(flat) if flat else np.empty(0, np.int32), size

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


def encode(docs: DataFrame, ranks: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `ids` (array of int) of every document. ranks: lines of the rank file."""
    @F.pandas_udf("array<int>")
    def ids_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(read_ranks(ranks), pattern)
        table = ChunkTable(codec.encode_chunks)
        for series in texts:
            yield pd.Series([x for a, b in slices(series) for x in table.ids([spaced_chunks(t) for t in series.iloc[a:b]])], dtype=object)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), ids_of(F.col(f"`{text_col}`").cast("string")).alias("ids"))


def decode(encoded_docs: DataFrame, ranks: list[bytes]) -> DataFrame:
    """All columns of an encode() result and `bytes`, decoded from the ids alone."""
    @F.pandas_udf("binary")
    def bytes_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = {i: t for t, i in read_ranks(ranks).items()}
        for series in ids:
            yield pd.Series([b"".join(map(token.__getitem__, x.tolist())) for x in series], dtype=object)
    return encoded_docs.withColumn("bytes", bytes_of("ids"))


def digest(docs: DataFrame, ranks: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's counts and digests, made where the ids are, so that neither ids nor bytes leave the task."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(read_ranks(ranks), pattern)
        table = ChunkTable(codec.encode_chunks)
        decimal = {i: str(i) for i in codec.token}
        for series in texts:
            rows = []
            for a, b in slices(series):
                for ids in table.ids([spaced_chunks(t) for t in series.iloc[a:b]]):
                    listed = ",".join(map(decimal.__getitem__, ids.tolist()))
                    rows.append((len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), digests(F.col(f"`{text_col}`").cast("string")).alias("d")).select("doc_id", "d.*")
