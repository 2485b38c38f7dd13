"""Helpers shared by the corpus operators: table access, fresh column names, word hashing in numpy."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def col(df: DataFrame, name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered up to a bounded number of words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: str | None, k: int, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer words is one shingle, one without words has none.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    k = min(k, len(parts))
    n = len(parts) - k + 1
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(acc)
