"""Periodic runs of words by enumeration of maximal pairs.

A run is a stretch of consecutive words with smallest period q, of at least max(min_words, 2q) words, that neither neighbour extends
keeping the period. Two places i < j = i + q whose longest common extension to the right is l words and whose left neighbours differ
are a maximal pair. A run of period q and L words is exactly the maximal pair (start, start + q) with l = L - q; so the pairs with
q <= l and q + l >= min_words are the runs, without any further extension. (A stretch also shows up with multiples of its smallest
period: the pair of smallest distance for a stretch is kept.)

A batch of documents becomes one array of word numbers, distinct between documents. Prefix doubling ranks all substrings of 1, 2,
4, ... words; the last ranking is the suffix order, and longest common prefixes of neighbours follow from the rankings. Only pairs of
l >= min_words / 2 matter, so all places whose words of that length do not come again in their document leave before the doubling.
The tree of LCP intervals is then walked from the leaves up. A node holds the sorted places of its subtree with the word left of each
(the class of a place); two subtrees are merged by looking up every place of the smaller one in the larger one, within the distance
that l allows and outside its own class. Places of one string that lie that close are an arithmetic progression whose members, except
the first, have the same left word, so a progression of the own class is left by one galloping search instead of one step a member.

One pass over the documents, no shuffle. Memory follows the batch (about `BATCH_WORDS` words) or one document, whichever is longer.

Null and empty texts have no words and no runs. Very long texts are handled whole. Ties and repeated rows get equal results each.
Null ids are kept. An empty table gives no rows. Other columns pass through; existing `runs` and `collapsed` columns are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import Codes

BATCH_WORDS = 400_000
RUNS = "array<struct<start:long,length:long,period:long>>"


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks of int64 keys from 1 on, equal keys alike."""
    order = np.argsort(key, kind="stable")
    step = np.ones(len(key), np.int64)
    step[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(step)
    return rank


def _ahead(rank: np.ndarray, end: np.ndarray, by: int) -> np.ndarray:
    """rank `by` places further on, 0 beyond the document's end (exclusive) of each place."""
    at = np.arange(len(rank)) + by
    return np.where(at < end, rank[np.minimum(at, len(rank) - 1)], 0)


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _dense(first * np.int64(1 << 31) + second)


def _again(words: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Whether the `length` words from each place on come twice or more in their document."""
    rank, have, spare, parts = words, 1, length, []
    while spare:
        if spare & 1:
            parts.append((rank, have))
        spare >>= 1
        if spare:
            rank, have = _ranked(rank, _ahead(rank, end, have)), have * 2
    total, at = parts[0]
    for r, h in parts[1:]:
        total = _ranked(total, _ahead(r, end, at))
        at += h
    whole = np.arange(len(words)) + length <= end
    count = np.bincount(total[whole], minlength=int(total.max(initial=0)) + 1)
    return whole & (count[total] > 1)


def _suffixes(words: np.ndarray, end: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of `among` in suffix order, longest common prefix of each with the one before); words are distinct between documents."""
    levels = [words]
    while levels[-1].max() < len(words):
        k = 1 << (len(levels) - 1)
        longer = _ranked(levels[-1], _ahead(levels[-1], end, k))
        if (longer == levels[-1]).all():
            break
        levels.append(longer)
    order = among[np.argsort(levels[-1][among], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    last = end[b] - 1
    stop = end[a]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < stop) & (b <= last)
        rank = levels[k]
        same = inside & (rank[np.minimum(a, len(rank) - 1)] == rank[np.minimum(b, len(rank) - 1)])
        by = np.where(same, 1 << k, 0)
        a, b, lcp = a + by, b + by, lcp + by
    return order, np.concatenate([np.zeros(1, np.int64), lcp])


def _partners(p: int, places: list[int], left: list[int], low: int, high: int, out: list[int]) -> None:
    """Places at a distance of low to high from p whose left word is another one."""
    own, n = left[p], len(places)
    i = bisect_left(places, p + low)
    while i < n and places[i] <= p + high:
        if left[places[i]] != own:
            out.append(places[i])
            i += 1
            continue
        i += 1
        if i < n and left[places[i]] == own:
            i = _leave(places, i - 1, places[i] - places[i - 1], 1) + 1
    i = bisect_left(places, p - low + 1) - 1
    while i >= 0 and places[i] >= p - high:
        if left[places[i]] != own:
            out.append(places[i])
            i -= 1
            continue
        i -= 1
        if i >= 0 and left[places[i]] == own:
            i = _leave(places, i + 1, places[i + 1] - places[i], -1)
            if left[places[i]] == own:
                i -= 1


def _leave(places: list[int], i: int, gap: int, way: int) -> int:
    """Last index, from i on in one direction, of the progression with this gap."""
    n, at = len(places), places[i]

    def on(k: int) -> bool:
        j = i + way * k
        return 0 <= j < n and places[j] == at + way * k * gap

    low, high = 1, 2
    while on(high):
        low, high = high, high * 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if on(mid) else (low, mid)
    return i + way * low


def _segment_pairs(order: list[int], lcp: list[int], left: list[int], min_words: int, note: Callable[[int, int, int], None]) -> None:
    """Maximal pairs of one subtree: order are its places in suffix order, lcp[k] belongs to order[k - 1] and order[k]."""
    stack: list[tuple[int, list[int]]] = []  # (common words with the next subtree, sorted places)
    n = len(order)
    for k in range(n):
        places, depth = [order[k]], lcp[k + 1] if k + 1 < n else 0
        while stack and stack[-1][0] >= depth:
            length, large = stack.pop()
            small = places
            if len(small) > len(large):
                small, large = large, small
            low = max(1, min_words - length)
            found: list[int] = []
            for p in small:
                _partners(p, large, left, low, length, found)
                for q in found:
                    note(min(p, q), abs(p - q), length)
                found.clear()
            if len(small) == 1:
                large.insert(bisect_left(large, small[0]), small[0])
            else:
                large += small
                large.sort()
            places = large
        stack.append((depth, places))


def runs_of(words: np.ndarray, sizes: np.ndarray, min_words: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period. words: the documents' word numbers, one after
    another; sizes: words of each document."""
    nothing = (np.empty(0, np.int64),) * 4
    least = (min_words + 1) // 2
    if not len(words):
        return nothing
    doc = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    own = _ranked(doc, words)
    again = _again(own, ends[doc], least)
    if not again.any():
        return nothing
    # documents that repeat nothing of that length leave
    stays = np.bincount(doc[again], minlength=len(sizes)) > 0
    kept = stays[doc]
    again, doc, own = again[kept], doc[kept], _dense(own[kept])
    size = np.where(stays, sizes, 0)
    ends = np.cumsum(size)
    first = (ends - size)[doc]
    end = ends[doc]
    order, lcp = _suffixes(own, end, np.flatnonzero(again))
    left = np.concatenate([np.zeros(1, np.int64), own[:-1]])
    left[np.arange(len(own)) == first] = -1
    # subtrees whose closest two places are further apart than its longest common prefix leave
    segment = np.cumsum(lcp < least) - 1
    by_place = np.lexsort((order, segment))
    gap = np.diff(order[by_place])
    gap[np.diff(segment[by_place]) > 0] = len(own)
    count = np.bincount(segment)
    nearest, longest = np.full(len(count), len(own), np.int64), np.zeros(len(count), np.int64)
    np.minimum.at(nearest, segment[by_place][1:], gap)
    np.maximum.at(longest, segment, np.where(lcp < least, 0, lcp))
    starts = np.cumsum(count) - count
    good = (count > 1) & (nearest <= longest)
    pair = good & (count == 2)
    a, b = order[starts[pair]], order[np.minimum(starts[pair] + 1, len(order) - 1)]
    i, q, n = np.minimum(a, b), np.abs(a - b), longest[pair]
    fits = (q <= n) & (q + n >= min_words) & (left[a] != left[b])
    found = [i[fits], q[fits], n[fits]]
    more: list[tuple[int, int, int]] = []
    left_words: list[int] = left.tolist() if (good & (count > 2)).any() else []
    for s in np.flatnonzero(good & (count > 2)):
        x, y = starts[s], starts[s] + count[s]
        _segment_pairs(order[x:y].tolist(), lcp[x:y].tolist(), left_words, min_words, lambda i, q, n: more.append((i, q, n)))
    if more:
        found = [np.concatenate([f, m]) for f, m in zip(found, np.array(more, np.int64).T, strict=True)]
    start, period, length = found[0], found[1], found[1] + found[2]
    if not len(start):
        return nothing
    by = np.lexsort((period, length, start))
    start, period, length = start[by], period[by], length[by]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, period, length = start[smallest], period[smallest], length[smallest]
    by = np.lexsort((period, start))
    start, period, length = start[by], period[by], length[by]
    return doc[start], start - first[start], length, period


def split_words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space."""
    return text.encode().split() if text else []


def _batch(docs: list[list[bytes]], codes: Codes, min_words: int) -> tuple[list[list[dict]], list[str]]:
    """Runs and collapsed text of every document."""
    sizes = np.array([*map(len, docs)], np.int64)
    words = np.concatenate([codes.of(d) for d in docs]) if docs else np.empty(0, np.int64)
    codes.new = []
    doc, start, length, period = runs_of(words, sizes, min_words)
    base = np.cumsum(sizes) - sizes
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, base[doc] + start + period, 1)
    np.add.at(edge, base[doc] + start + length, -1)
    keep = np.cumsum(edge)[:-1] == 0
    runs: list[list[dict]] = [[] for _ in docs]
    for d, s, n, q in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        runs[d].append({"start": s, "length": n, "period": q})
    texts = []
    for d, b in zip(docs, base.tolist(), strict=True):
        own = keep[b:b + len(d)]
        texts.append(b" ".join(d if own.all() else [d[i] for i in np.flatnonzero(own)]).decode())
    return runs, texts


def detect_runs(docs: DataFrame, min_words: int = 12, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with `runs` (start, length and period of each, in words from 0, by start and period) and `collapsed`: the words
    joined by single spaces, without those that a run holds after its first period.

    prepare: rewrites the words of a document first; it gets its id and words.
    """
    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for ids, texts in batches:
            runs: list[list[dict]] = []
            collapsed: list[str] = []
            held: list[list[bytes]] = []
            size = 0
            for i, t in zip(ids, texts, strict=True):
                words = split_words(t)
                held.append(prepare(None if pd.isna(i) else int(i), words) if prepare else words)
                size += len(words)
                if size >= BATCH_WORDS:
                    r, c = _batch(held, codes, min_words)
                    runs, collapsed, held, size = runs + r, collapsed + c, [], 0
                    if len(codes) > BATCH_WORDS:
                        codes.clear()
            r, c = _batch(held, codes, min_words)
            yield pd.DataFrame({"runs": runs + r, "collapsed": collapsed + c})

    text, key = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`").cast("long")
    out = docs.withColumn("runs", found(key, text))
    return out.withColumn("collapsed", F.col("runs.collapsed")).withColumn("runs", F.col("runs.runs"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and the hashes of all runs and of the collapsed text."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    d = found.select(F.col(f"`{id_col}`").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                     F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
                    F.expr("b.length * 1000 div -b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
