"""Token ids in a compressed binary store: static range asymmetric numeral coding with interleaved lanes, blocks and checkpoints.

A store is a table of shards in ascending order of document id. A shard is one self-contained binary value:

  header      magic, number of documents, tokens, symbols, blocks, words
  directory   document ids (with a null flag) and their token counts
  table       ids that occur and their frequencies, which add up to 2**20; shared by all blocks of the shard
  checkpoints per block: place of its first word, number of words, CRC-32 of its ids; final state of every lane
  words       32-bit words of all blocks

A block of BLOCK tokens is coded by LANES interleaved states and needs nothing from other blocks, so blocks decode in any order and
many at once: one numpy step codes a token in every lane of every block. A shard closes after SHARD_TOKENS ids, so memory does not
depend on how many documents a task has.

Null and empty texts have the end id only. Rows of equal id are kept, in the order of a hash of their text; null ids come first.
An empty table gives an empty store. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import spaced_chunks
from tidemark.llm.library import encoded
from tidemark.session import materialise

MAGIC = b"TMR1"
BITS, LOW = 20, 31
BLOCK, LANES = 16_384, 32
SHARD_TOKENS = 2_000_000
STORE = "part int, seq int, n_docs long, n_tokens long, shard binary"


def frequencies(count: np.ndarray) -> np.ndarray:
    """Positive whole frequencies that add up to 2**BITS, close to the counts (at most 2**BITS symbols)."""
    room = (1 << BITS) - len(count)
    f = 1 + (count.astype(np.float64) * room / count.sum()).astype(np.int64)
    f[np.argmax(count)] += (1 << BITS) - f.sum()
    return f.astype(np.uint64)


def write_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    count = np.bincount(ids)
    symbols = np.flatnonzero(count)
    place, count = np.cumsum(count > 0) - 1, count[symbols]
    index = place[ids]
    f = frequencies(count)
    c = np.cumsum(f) - f
    blocks = -(-len(ids) // BLOCK)
    steps = BLOCK // LANES
    padded = np.full(blocks * BLOCK, np.argmax(count), np.int64)
    padded[:len(ids)] = index
    padded = padded.reshape(blocks, steps, LANES)
    x = np.full((blocks, LANES), 1 << LOW, np.uint64)
    out, word = np.zeros((steps, blocks, LANES), bool), np.zeros((steps, blocks, LANES), np.uint32)
    for t in range(steps - 1, -1, -1):
        s = padded[:, t, :]
        fs = f[s]
        full = x >= fs << np.uint64(LOW - BITS + 32)
        out[t], word[t] = full, (x & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        x = np.where(full, x >> np.uint64(32), x)
        q = x // fs
        x = (q << np.uint64(BITS)) + (x - q * fs) + c[s]
    out, word = out.transpose(1, 0, 2), word.transpose(1, 0, 2)
    n_words = out.reshape(blocks, -1).sum(1)
    raw = ids.astype("<u4")
    crc = [zlib.crc32(raw[b * BLOCK:(b + 1) * BLOCK].tobytes()) for b in range(blocks)]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        struct.pack("<4s5q", MAGIC, len(doc_ids), len(ids), len(symbols), blocks, int(n_words.sum())),
        known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes(),
        symbols.astype("<u4").tobytes(), f.astype("<u4").tobytes(),
        (np.cumsum(n_words) - n_words).astype("<i8").tobytes(), n_words.astype("<i8").tobytes(), np.array(crc, "<u4").tobytes(),
        x.astype("<u8").tobytes(), word[out].astype("<u4").tobytes()]
    return b"".join(parts)


class Shard:
    """A shard opened for reading."""

    def __init__(self, data: bytes) -> None:
        magic, docs, self.tokens, symbols, self.blocks, words = struct.unpack_from("<4s5q", data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize("<4s5q")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        known, ids = take("u1", docs), take("<i8", docs)
        self.doc_ids = [int(i) if k else None for k, i in zip(known, ids, strict=True)]
        self.lengths = take("<i8", docs)
        self.symbols, self.f = take("<u4", symbols), take("<u4", symbols).astype(np.uint64)
        self.first, self.n_words, self.crc = take("<i8", self.blocks), take("<i8", self.blocks), take("<u4", self.blocks)
        self.state = take("<u8", self.blocks * LANES).reshape(-1, LANES)
        self.words = np.concatenate([take("<u4", words), np.zeros(1, "<u4")]).astype(np.uint64)
        self.c = np.cumsum(self.f) - self.f
        self.symbol_at = np.repeat(np.arange(symbols), self.f.astype(np.int64))

    def decode_blocks(self, a: int, b: int) -> np.ndarray:
        """Ids of the blocks a to b - 1, decoded side by side and checked against their checksums."""
        x, at = self.state[a:b].copy(), self.first[a:b].copy()
        steps = BLOCK // LANES
        index = np.empty((steps, b - a, LANES), np.int64)
        mask = np.uint64((1 << BITS) - 1)
        for t in range(steps):
            slot = x & mask
            s = self.symbol_at[slot.astype(np.int64)]
            index[t] = s
            x = self.f[s] * (x >> np.uint64(BITS)) + slot - self.c[s]
            low = x < np.uint64(1 << LOW)
            taken = np.cumsum(low, axis=1)
            place = np.where(low, at[:, None] + taken - 1, len(self.words) - 1)
            x = np.where(low, (x << np.uint64(32)) | self.words[place], x)
            at = at + taken[:, -1]
        ids = self.symbols[index.transpose(1, 0, 2).ravel()][:max(0, self.tokens - a * BLOCK)]
        for i in range(a, b):
            if zlib.crc32(ids[(i - a) * BLOCK:(i - a + 1) * BLOCK].tobytes()) != self.crc[i]:
                raise ValueError(f"block {i} is damaged")
        return ids

    def read(self, start: int, n: int) -> np.ndarray:
        """n ids from `start` on: only the blocks that hold them are decoded."""
        if n <= 0:
            return np.empty(0, "<u4")
        a, b = start // BLOCK, -(-(start + n) // BLOCK)
        return self.decode_blocks(a, min(b, self.blocks))[start - a * BLOCK:start - a * BLOCK + n]


def write_store(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The store's shards, written to the shared folder: part, seq (their order), n_docs, n_tokens, shard."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size, end = 0, np.array([end_id], np.int32)
        ids_of: list[pd.Series] = []

        def texts() -> Iterator[pd.Series]:
            for b in batches:
                ids_of.append(b["doc_id"])
                yield b["text"]

        def shard() -> pd.DataFrame:
            blob = write_shard(names, [len(x) for x in held], np.concatenate(held))
            return pd.DataFrame({"part": [part], "seq": [seq], "n_docs": [len(names)], "n_tokens": [size], "shard": [blob]})

        for at, rows in encoded(texts(), tokenizer, spaced_chunks, " "):
            own = ids_of[-1].iloc[at:at + len(rows)]
            for d, ids in zip(own, rows, strict=True):
                names.append(None if pd.isna(d) else int(d))
                held.append(np.concatenate([ids, end]))
                size += len(held[-1])
                if size >= SHARD_TOKENS:
                    yield shard()
                    seq, size = seq + 1, 0
                    names.clear()
                    held.clear()
            if not rows:
                ids_of.clear()
        if names:
            yield shard()

    text = F.col(f"`{text_col}`").cast("string")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    ordered = d.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return materialise(ordered.mapInPandas(write, STORE), "token_store")


def read_store(store: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the shards alone."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, seq, data in zip(b["part"], b["seq"], b["shard"], strict=True):
                s = Shard(data)
                ids, ends = s.decode_blocks(0, s.blocks), np.cumsum(s.lengths)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, s.lengths, strict=True)]
                yield pd.DataFrame({"part": part, "seq": seq, "doc_id": pd.array(s.doc_ids, "Int64"), "at": ends - s.lengths, "n_tokens": s.lengths, "ids_crc32": crc})

    rows = store.select("part", "seq", "shard").mapInPandas(read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = store.select("part", "seq", F.col("n_tokens").alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("part_base"))
    base = sizes.select("part", "seq", before(Window.partitionBy("part").orderBy("seq")).alias("base")).join(parts, "part")
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("part_base") + F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
