"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics are SQL expressions over the whole text (counts, ratios; never id, language, source or labels). They are computed once
and stored. Random cosine features approximate a Gaussian kernel on the scaled statistics. Every partition adds up its own normal
equations; the sums, whose size depends on the number of features only, are solved by ridge regression. Calibration counts labels
per narrow score bin on a fold that the regression has not seen and fits the rising step function by pooling adjacent violators.

Learning uses all labelled rows with crc32(id) mod 5 in 2, 3, 4 (regression) and 1 (calibration); 0 is held out. Null labels are
ignored, several labels of an id are averaged. Null and empty texts have statistics of zero and a score like any other. Without a
labelled row every score is 0.5. Rows of a null id are scored and count as held out. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import n_dup_lines, n_symbols, words
from tidemark.session import materialise

COSINES = 256
RIDGE = 1e-4       # per labelled row
CLIP = 4.0
BINS = 2000
SEED = 31


def _per(a: Column, b: Column) -> Column:
    return F.coalesce(a.cast("double") / F.when(b > 0, b), F.lit(0.0))


def statistics(t: Column, w: Column) -> dict[str, Column]:
    """name -> statistic of a text t with words w."""
    n, chars = F.size(w), F.length(t)
    gone = lambda pattern: chars - F.length(F.regexp_replace(t, pattern, ""))
    lines = F.size(F.split(t, "\n"))
    return {
        "log_words": F.log1p(n.cast("double")),
        "word_length": _per(F.length(F.array_join(w, "")), n),
        "symbols": F.log1p(_per(n_symbols(t), n)),
        "distinct": _per(F.size(F.array_distinct(w)), n),
        "capitals": _per(gone("[A-Z]+"), chars),
        "digits": _per(gone("[0-9]+"), chars),
        "stops": _per(gone("[.,;:]+"), n),
        "bangs": F.log1p(_per(gone("[!?]+"), n)),
        "dup_lines": _per(n_dup_lines(t), lines),
        "log_lines": F.log1p(_per(lines, n)),
        "wide": _per(F.octet_length(t) - chars, chars),
        "pairs": _per(F.size(F.array_distinct(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1))))), n),
    }


NAMES = ["log_words", "word_length", "symbols", "distinct", "capitals", "digits", "stops", "bangs", "dup_lines", "log_lines", "wide", "pairs"]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fold (crc32 of the id as text, mod 5) and x, the array of statistics, of every document."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), t.alias("t")).withColumn("w", words(F.col("t")))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return d.select("doc_id", F.coalesce(fold, F.lit(0)).cast("int").alias("fold"), F.array(*statistics(F.col("t"), F.col("w")).values()).alias("x"))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.standard_normal((x.shape[1], COSINES)) / np.sqrt(x.shape[1])
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.ones((len(x), 1)), z, np.sqrt(2 / COSINES) * np.cos(z @ w + rng.random(COSINES) * 2 * np.pi)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated score; the raw score keeps a thousandth, so that equal steps keep their order."""
        r = self.raw(x)
        step = np.interp(r, self.knots, self.values) if len(self.knots) else np.full(len(r), 0.5)
        return np.clip(0.999 * step + 0.001 * np.clip(r, 0, 1), 0, 1) if len(self.knots) else step


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, len(NAMES)))


def pool_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Rising fit of least squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(described: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id") -> QualityModel:
    """described: a stored describe() result."""
    y = labels.select(F.col(f"`{label_id}`").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y")).where("doc_id is not null and y is not null")
    rows = materialise(described.where("fold > 0").join(y.groupBy("doc_id").agg(F.avg("y").alias("y")), "doc_id").select("fold", "x", "y"), "labelled")
    own = rows.where("fold > 1")
    moments = own.agg(F.count("*"), *(f(F.get("x", F.lit(i))) for i in range(len(NAMES)) for f in (F.avg, F.stddev_pop))).first()
    m = np.array([v or 0.0 for v in moments[1:]], np.float64).reshape(-1, 2)
    model = QualityModel(m[:, 0], np.maximum(m[:, 1], 1e-3), np.zeros(1 + len(NAMES) + COSINES), np.empty(0), np.empty(0))
    if not moments[0]:
        return model
    width = len(model.weights)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width + 1))
        for b in batches:
            z = model.cosines(_matrix(b["x"]))
            total += z.T @ np.column_stack([z, b["y"]])
        yield pd.DataFrame({"i": np.arange(width), "a": list(total)})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"].iloc[:1], "a": [np.sum(np.stack(group["a"].to_numpy()), axis=0)]})

    equations = own.select("x", "y").mapInPandas(sums, "i int, a array<double>").groupBy("i").applyInPandas(added, "i int, a array<double>").orderBy("i").collect()
    a = np.array([r["a"] for r in equations])
    model.weights = np.linalg.solve(a[:, :-1] + np.eye(width) * RIDGE * moments[0], a[:, -1])

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(_matrix(x)))

    edge = F.floor(F.least(F.greatest(raw("x"), F.lit(-0.5)), F.lit(1.5)) * (BINS / 2)).cast("int")
    bins = rows.where("fold = 1").select(edge.alias("bin"), "y").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    if bins:
        fitted = pool_violators(np.array([b["y"] for b in bins]), np.array([b["n"] for b in bins], float))
        centre = (np.array([b["bin"] for b in bins]) + 0.5) / (BINS / 2)
        _, first, size = np.unique(fitted, return_index=True, return_counts=True)
        model.knots = np.array([centre[f:f + s].mean() for f, s in zip(first, size, strict=True)])
        model.values = fitted[first]
    return model


def score_documents(described: DataFrame, model: QualityModel, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every described document."""
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(x)))
    return described.select("doc_id", (F.col("fold") == 0).alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    described = materialise(describe(docs, id_col, text_col), "statistics")
    return score_documents(described, fit(described, labels))
