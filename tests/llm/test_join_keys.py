"""Keys of the Jaccard join: none for empty blocks, a shared one for every linked pair, few candidates among unrelated sets."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import jaccard_join as jj

LIKES = [jj.Likeness(5, 80, 100), jj.Likeness(3, 90, 100), jj.Likeness(2, 60, 100)]


def keys(h: np.ndarray, like: jj.Likeness) -> set[int]:
    edges = like.bands()
    own, out = int(np.searchsorted(edges, len(h), "right")) - 1, set()
    for band in (own, own + 1):
        p = jj.partition(like.allowed(2 * (int(edges[band + 1]) - 1)), int(edges[max(0, band - 1)]))
        if p.d:
            out |= set(jj.filled_keys(h, band, p).tolist())
    return out


def random_set(rng: np.random.Generator, n: int) -> np.ndarray:
    return np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))


@pytest.mark.parametrize("like", LIKES)
def test_every_linked_pair_shares_a_key(like):
    rng, rnd, linked = np.random.default_rng(6), random.Random(6), 0
    for _ in range(3000):
        a = random_set(rng, rnd.choice([2, 5, 8, 9, 10, 12, 16, 25, 40, 90, 300]))
        change = rnd.randint(0, max(1, like.allowed(2 * len(a))))
        out = rnd.randint(0, change)
        b = np.unique(np.concatenate([rng.permutation(a)[min(out, len(a) - 1):], random_set(rng, change - out)]))
        both = len(np.intersect1d(a, b))
        if both * like.den >= (len(a) + len(b) - both) * like.num and len(np.setxor1d(a, b)):
            linked += 1
            assert keys(a, like) & keys(b, like)
    assert linked > 1000


@pytest.mark.parametrize("like", LIKES)
@pytest.mark.parametrize("n", [9, 30, 100, 400])
def test_unrelated_sets_share_no_key(like, n):
    rng = np.random.default_rng(7)
    seen = Counter(k for _ in range(1500) for k in keys(random_set(rng, n), like))
    assert max(seen.values()) == 1


def test_wide_sketches_bound_the_difference_and_tell_unrelated_sets_apart():
    rng = np.random.default_rng(8)
    for n in (1, 200, 700, 3000):
        a = random_set(rng, n)
        for b in (random_set(rng, n), random_set(rng, 2 * n), np.unique(np.concatenate([a[n // 9:], random_set(rng, n // 9 + 1)]))):
            x = jj.wide_distance(jj.wide_parity(a), jj.wide_parity(b))
            assert x <= len(np.setxor1d(a, b))
        if n > 100:
            assert jj.wide_distance(jj.wide_parity(a), jj.wide_parity(random_set(rng, n))) * 180 > 2 * n * 20


def test_chunks_of_a_hot_leader_agree(spark, monkeypatch):
    monkeypatch.setattr(jj, "CHUNK", 7)
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(120)]
    texts = [" ".join([*base[:k], f"x{i}", *base[k + 1:]]) for i, k in enumerate(rnd.choices(range(120), k=150))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    assert jj.near_duplicate_components(d, jj.Likeness(5, 80, 100)).select("component_id").distinct().count() == 1


def test_short_texts_without_anything_in_common_stay_apart(spark):
    d = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(12 + i % 9))) for i in range(800)], "doc_id long, text string")
    got = jj.near_duplicate_components(d, jj.Likeness(5, 80, 100))
    assert got.where("component_id <> doc_id").count() == 0 and got.count() == 800


def test_narrow_sketches_bound_the_difference(spark):
    rng = np.random.default_rng(9)
    sets = [random_set(rng, n) for n in (3, 250, 260, 900, 1100, 5000, 9000)]
    sets += [np.unique(np.concatenate([s[len(s) // 12:], random_set(rng, len(s) // 12 + 1)])) for s in sets]
    rows = [(i, jj.narrow_words(jj.wide_parity(s)).tolist()) for i, s in enumerate(sets)]
    assert max(len(w) for _, w in rows) == jj.NARROW_WORDS
    d = spark.createDataFrame(rows, "i int, w array<long>")
    x, y = d.toDF("i", "x"), d.toDF("j", "y")
    got = x.crossJoin(y).select("i", "j", jj.narrow_distance(x["x"], y["y"]).alias("bits")).collect()
    for i, j, bits in got:
        assert bits <= len(np.setxor1d(sets[i], sets[j]))
    assert any(bits > 0 for i, j, bits in got if len(rows[i][1]) != len(rows[j][1]))


def test_long_texts_with_a_shared_passage_make_no_candidates(spark, monkeypatch):
    rnd, seen, store = random.Random(3), {}, jj.materialise

    def counted(df, name=None):
        out = store(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jj, "materialise", counted)
    passage = [f"p{rnd.randint(0, 10**6)}" for _ in range(1400)]
    texts = [" ".join([*passage, *(f"t{i}x{k}" for k in range(700))]) for i in range(40)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = jj.near_duplicate_components(d, jj.Likeness(5, 80, 100))
    assert got.where("component_id <> doc_id").count() == 0
    assert seen["rest_pairs"] == 0
