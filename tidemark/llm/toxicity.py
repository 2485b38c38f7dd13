"""Toxicity by a classifier chain over hashed word-start features.

A document's features are the distinct letter runs of its whole lower-cased text and their first three, four and five letters, hashed
into BINS bins. On the learning sample Spark counts the documents per bin and category; the bins of largest chi-square become the
inputs, if at least MIN_SHARE of the documents with the bin are of a category, and at least
MIN_DOCS and MIN_SUPPORT of the category have it. Categories are learnt in their given order by ridge-penalised logistic regression; each later model also gets the probabilities
of the earlier categories. For learning these are out-of-fold predictions, so that a later model sees errors as it will when scoring.

The sample is bounded: the MAX_ROWS labelled documents of smallest id hash (parameter max_rows), without those of crc32(id) mod 5 = 0,
which stay held out. Null labels are ignored; for several labels of an id the largest counts. Null and empty texts have no features
and get the base rate. Without labelled rows every probability is 0. Rows of a null id are scored. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh
from tidemark.session import materialise

BINS = 1 << 18
INPUTS = 320
MIN_SHARE = 0.3
MIN_DOCS, MIN_SUPPORT = 5, 0.02
MAX_ROWS = 12_000
FOLDS = 4
PENALTY = 0.3
REJECT = 0.5
STARTS = (3, 4, 5)
LETTERS = re.compile(r"[^\W\d_]+")


class FeatureBins(dict):
    """token between white space -> bins of its letter runs; remembered up to a bounded number of tokens."""

    LIMIT = 300_000

    def __init__(self, wanted: set[int] | None = None) -> None:
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        names = {n for run in LETTERS.findall(token) for n in (run, *(f"{k}^{run[:k]}" for k in STARTS if len(run) >= k))}
        bins = (xxhash.xxh32_intdigest(n) & (BINS - 1) for n in names)
        out = self[token] = tuple(b for b in bins if self.wanted is None or b in self.wanted)
        return out

    def of(self, text: str | None) -> set[int]:
        found: set[int] = set()
        for token in set(text.lower().split()) if text else ():
            found.update(self[token])
        return found


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 12) -> np.ndarray:
    """Newton steps; the last weight is the intercept, which is not penalised."""
    a = np.column_stack([x, np.ones(len(x), x.dtype)]).astype(np.float64)
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(a @ w)
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge), grad)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Chain:
    categories: list[str]
    bins: np.ndarray                       # chosen bins, ascending
    weights: list[np.ndarray] = field(default_factory=list)

    def inputs(self, found: list[set[int]]) -> np.ndarray:
        x = np.zeros((len(found), len(self.bins)), np.float32)
        at = {int(b): i for i, b in enumerate(self.bins)}
        for r, f in enumerate(found):
            for b in f:
                if b in at:
                    x[r, at[b]] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, one column per category in chain order."""
        out = np.empty((len(x), 0))
        for w in self.weights:
            z = np.column_stack([x, out]) @ w[:-1] + w[-1]
            out = np.column_stack([out, sigmoid(z)])
        return out if self.weights else np.zeros((len(x), len(self.categories)))


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int, id_col: str, text_col: str) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(F.col(c).cast("int")).alias(c) for c in categories))
    known = known.where(" and ".join(f"`{c}` is not null" for c in categories))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return d.join(F.broadcast(known), "doc_id").select("doc_id", "text", *categories)      # at most max_rows rows, so texts stay where they are


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """labels: doc_id and a 0/1 column per category; categories: chain order."""
    @F.pandas_udf("array<int>")
    def bins_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bins = FeatureBins()
        for t in texts:
            yield pd.Series([np.fromiter(bins.of(x), np.int32) for x in t], dtype=object)

    sample = materialise(_sample(docs, labels, categories, max_rows, id_col, text_col).select("doc_id", bins_of("text").alias("found"), *categories), "toxic_sample")
    block = 4096

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((1 + len(categories), BINS), np.int64)
        for b in batches:
            for i, c in enumerate([None, *categories]):
                own = b["found"] if c is None else b["found"][b[c] > 0]
                if len(own):
                    n[i] += np.bincount(np.concatenate(own.to_numpy()).astype(np.int64), minlength=BINS)
        for k in range(0, BINS, block):
            if n[0, k:k + block].any():
                yield pd.DataFrame({"k": [k], "n": [n[:, k:k + block].ravel()]})

    def added(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": g["k"].iloc[:1], "n": [np.sum(np.stack(g["n"].to_numpy()), axis=0)]})

    counted = sample.select("found", *categories).mapInPandas(tally, "k int, n array<long>").groupBy("k").applyInPandas(added, "k int, n array<long>").collect()
    n = np.zeros((1 + len(categories), BINS))
    for r in counted:
        n[:, r["k"]:r["k"] + block] = np.array(r["n"]).reshape(-1, block)
    rows = sample.agg(F.count("*"), *(F.sum(c) for c in categories)).first()
    total = rows[0]
    chain = Chain(categories, np.empty(0, np.int64))
    if not total:
        return chain
    best = np.zeros(BINS)
    for i, c in enumerate(categories, 1):
        pos = rows[i] or 0
        want = n[0] * pos / total
        spread = want * (1 - pos / total) * np.maximum(1 - n[0] / total, 1e-9) + 1
        telling = (n[i] >= MIN_SHARE * n[0]) & (n[i] >= max(MIN_DOCS, MIN_SUPPORT * pos))
        best = np.maximum(best, np.where(telling, (n[i] - want) ** 2 / spread, 0))
    top = np.lexsort((np.arange(BINS), -best))[:INPUTS]
    chain.bins = np.sort(top[best[top] > 0])
    chosen = F.array(*(F.lit(int(b)) for b in chain.bins)) if len(chain.bins) else F.array().cast("array<int>")
    local = sample.select("doc_id", F.array_intersect("found", chosen).alias("found"), *categories).orderBy("doc_id").toPandas()  # at most max_rows
    x = chain.inputs([set(f) for f in local["found"]])
    fold = np.array([xxhash.xxh32_intdigest(str(d)) % FOLDS for d in local["doc_id"]])
    earlier = np.empty((len(x), 0))
    for c in categories:
        y, a = local[c].to_numpy(float), np.column_stack([x, earlier])
        unseen = np.full(len(y), y.mean())
        for k in range(FOLDS):
            if (fold == k).any() and (fold != k).any():
                w = logistic(a[fold != k], y[fold != k])
                unseen[fold == k] = sigmoid(a[fold == k] @ w[:-1] + w[-1])
        chain.weights.append(logistic(a, y))
        earlier = np.column_stack([earlier, unseen])
    return chain


def probabilities(text: Column, chain: Chain) -> Column:
    """Struct of one double per category."""
    @F.pandas_udf(", ".join(f"`{c}` double" for c in chain.categories))
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bins = FeatureBins(set(chain.bins.tolist()))
        for t in texts:
            p = [chain.predict(chain.inputs([bins.of(x) for x in t.iloc[a:a + 2000]])) for a in range(0, len(t), 2000)]
            yield pd.DataFrame(np.vstack(p) if p else np.empty((0, len(chain.categories))), columns=chain.categories)
    return scored(text)


def label_categories(labels: DataFrame) -> DataFrame:
    """Chain targets from labels (doc_id, quality, toxic): abuse in junk, abuse in prose, any abuse."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return labels.select("doc_id", (toxic & ~good).cast("int").alias("toxic_junk"), (toxic & good).cast("int").alias("toxic_prose"), toxic.cast("int").alias("toxic"))


CATEGORIES = ["toxic_junk", "toxic_prose", "toxic"]


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """doc_id, held_out, p_<category>..., rejected (by the chain's last category)."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), probabilities(F.col(f"`{text_col}`").cast("string"), chain).alias("p"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return d.select("doc_id", held.alias("held_out"), *(F.col(f"p.{c}").alias(f"p_{c}") for c in chain.categories),
                    (F.col(f"p.{chain.categories[-1]}") >= reject).alias("rejected"))


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    p = fresh(docs, "p")
    kept = docs.withColumn(p, probabilities(F.col(f"`{text_col}`").cast("string"), chain)).where(F.col(f"{p}.{chain.categories[-1]}") < reject)
    return kept.select(*(col(docs, c) for c in docs.columns))
