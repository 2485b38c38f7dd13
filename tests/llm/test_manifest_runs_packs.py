"""Merkle manifest, periodic runs and histogram packing against plain versions, on the small tables and on edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import CLASH, SMALL, edge_texts

from tidemark.llm import histogram_packing, merkle, periodic
from tidemark.llm.library import read_tokenizer
from tidemark.llm.queries import QUERIES, repeat_by_id

WORD_SPLIT = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def edge(spark):
    texts = [*edge_texts(), "a\x1cb a\x1cb " * 8, "x y z " * 40 + "end", "p " * 500, None, "same text", "same text", "cut\nhere\n"]
    rows = [(i, t, None if i % 5 == 0 else "en", ("é", None, "s", "", "z")[i % 5], None if i % 3 else i, "w", "s", "h", "t", "p", "n", "ab") for i, t in enumerate(texts)]
    rows += [(None, "null id text here", *[None] * 10), rows[5], rows[5], (*rows[6][:1], "same id, other text", *rows[6][2:])]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(params=["small", "edge"])
def docs(request, spark, edge):
    return spark.read.parquet(f"{SMALL}/documents.parquet") if request.param == "small" else edge


def plain(v):
    return None if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else v


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def split(text):
    out, word = [], ""
    for c in text or "":
        if c in WORD_SPLIT:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return [*out, word] if word else out


# --- runs ---

def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k < len(w) - q:
            s = k
            while k < len(w) - q and w[k] == w[k + q]:
                k += 1
            if k - s >= q and k - s + q >= least:
                found.setdefault((s, k - s + q), q)
            k += k == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(i, w):
    code = zlib.crc32(str(i).encode()) if i is not None else 1
    if code % 10 or not w:
        return w
    g = code // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def runs_row(i, text):
    w = planted(i, split(text))
    found = plain_runs(w) if len(w) < 4000 else None
    if found is None:  # the plain version is quadratic
        d, s, n, q = periodic.runs_of(np.unique(w, return_inverse=True)[1].astype(np.int64), np.array([len(w)]))
        found = list(zip(s.tolist(), n.tolist(), q.tolist(), strict=True))
        for s, n, q in found:
            assert w[s:s + n - q] == w[s + q:s + n] and n >= 2 * q and n >= 12
            assert (s == 0 or w[s - 1] != w[s - 1 + q]) and (s + n == len(w) or w[s + n] != w[s + n - q])
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(found), *best, best[1] * 1000 // best[2] if found else None, h(*(f"{s},{n},{q}\n" for s, n, q in found)), h(kept))


def test_runs_query_against_definition(docs):
    got = rows(periodic.digest(periodic.detect_runs(docs, 12, repeat_by_id)))
    want = sorted((runs_row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert got == want and sum(r[1] for r in got) > 3


def test_runs_pass_other_columns(edge, empty):
    found = periodic.detect_runs(edge)
    assert set(edge.columns) <= set(found.columns) and found.count() == edge.count()
    assert periodic.digest(periodic.detect_runs(empty)).count() == 0


def test_runs_of_many_shapes():
    rnd = random.Random(11)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            p, size, letters = rnd.randint(1, 25), rnd.randint(0, 100), rnd.randint(1, 4)
            block = [rnd.randint(0, letters) for _ in range(p)]
            w = [block[i % p] for i in range(size)] if rnd.random() < 0.4 else [rnd.randint(0, letters) for _ in range(size)]
            texts.append(w + [9] * rnd.randint(0, 14) if rnd.random() < 0.3 else w)
        least = rnd.choice([2, 6, 12, 13])
        got = [[] for _ in texts]
        for d, *r in zip(*(x.tolist() for x in periodic.runs_of(np.array([x for w in texts for x in w], np.int64), np.array([*map(len, texts)]), least)), strict=True):
            got[d].append(tuple(r))
        assert got == [plain_runs(w, least) for w in texts]


@pytest.mark.parametrize("words", [[0] * 20_000, [0, 1] * 10_000, list(range(100)) * 200, ([0] * 300 + [7]) * 60])
def test_long_regular_texts_end_soon(words):
    d, s, n, q = periodic.runs_of(np.array(words, np.int64), np.array([len(words)]))
    assert (0, len(words)) in list(zip(s.tolist(), n.tolist(), strict=True))


# --- manifest ---

def plain_tree(nodes):
    """(top, siblings of every node level by level: (left, right))."""
    proofs, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, k in enumerate(at):
            a = k - k % 3
            proofs[i].append((level[a:k], level[k + 1:a + 3]))
        at = [k // 3 for k in at]
        level = [h(*level[a:a + 3]) for a in range(0, len(level), 3)]
    return level[0], proofs


def plain_manifest(docs):
    def leaf(r, text):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
    sources = {}
    for r in docs:
        own = leaf(r, r["text"])
        cut = r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        sources.setdefault(r["source"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0), own, leaf(r, r["text"].replace("\n", "")) if cut else own, r["doc_id"]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[1] for x in sorted(sources[s])]) for s in names}
    root, upper = plain_tree([trees[s][0] for s in names])
    out = []
    for s, over in zip(names, upper, strict=True):
        for x, proof in zip(sorted(sources[s]), trees[s][1], strict=True):
            folded = x[2]
            for left, right in proof + over:
                folded = h(*left, folded, *right)
            out.append((x[3], x[1], trees[s][0], root, h(*(y for left, right in proof + over for y in (*left, *right))), folded, folded == root))
    return sorted(out, key=repr)


def manifest(docs, levels=8):
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(docs, changed, levels=levels)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(docs, levels):
    got = rows(manifest(docs, levels))
    assert got == plain_manifest(docs.select(*merkle.FIELDS).collect())
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_the_query_and_of_one_or_no_rows(spark, empty):
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows(QUERIES["op13_merkle_manifest"](spark, SMALL)) == plain_manifest(small.collect())
    assert manifest(empty).count() == 0 and manifest(empty).columns == manifest(small.limit(1)).columns
    one = manifest(small.limit(1)).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h()


# --- packing ---

def test_histogram_packing(docs, empty):
    from tokenizers import Tokenizer
    name = public_tokenizers.path("byte_bpe_50k.json")
    t, tokenizer = Tokenizer.from_file(name), read_tokenizer(name)
    for capacity in (64, 2048):
        got = histogram_packing.pack_documents(docs, tokenizer, 1, capacity).toPandas()
        sizes = []
        for _, s in got.sort_values("offset").groupby("sequence_id"):
            assert (s["length"].cumsum() - s["length"]).tolist() == s["offset"].tolist()
            sizes.append(int(s["length"].sum()))
        assert max(sizes) <= capacity and all(n & (n - 1) == 0 for n in sizes)  # nothing is padded
        want = {}
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
            want.setdefault(r["doc_id"], []).append(ids)
        assert int(got["length"].sum()) == sum(len(x) for v in want.values() for x in v) and (got["length"] > 0).all()
        for d, ids in want.items():
            own = got[got["doc_id"].isna()] if d is None else got[got["doc_id"] == d]
            if len(ids) > 1:  # repeated ids
                assert own["length"].sum() == sum(map(len, ids))
                continue
            own = own.sort_values("start")
            assert (own["doc_tokens"] == len(ids[0])).all() and own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
            assert own["ids_crc32"].tolist() == [zlib.crc32(ids[0][a:a + n].tobytes()) for a, n in zip(own["start"], own["length"], strict=True)]
    assert histogram_packing.pack_documents(empty, tokenizer, 1).count() == 0


def test_plans_leave_no_padding():
    rnd = random.Random(3)
    for _ in range(200):
        capacity = rnd.choice([8, 16, 64, 2048])
        counts = {rnd.randint(1, capacity - 1): rnd.randint(1, rnd.choice([1, 3, 40])) for _ in range(rnd.randint(0, 12))}
        plan, held = histogram_packing.make_plan(counts, capacity), {}
        for length, n in counts.items():
            for s, o, token in zip(*plan.place(np.full(n, length), np.arange(n)), strict=True):
                parts = [(0, length, s, o)] if token < 0 else plan.cuts(int(token), length)
                assert sum(p[1] for p in parts) == length
                for _, k, q, at in parts:
                    held.setdefault(int(q), []).append((int(at), k))
        for items in held.values():
            at = 0
            for o, k in sorted(items):
                assert o == at
                at += k
            assert at <= capacity and at & (at - 1) == 0
        with pytest.raises(ValueError):
            histogram_packing.pack_documents(None, "", 1, 100)


def test_a_huge_histogram_stays_small():
    """2,047 lengths of up to a thousand million tails each: the plan follows the lengths, not the tails."""
    plan = histogram_packing.make_plan({k: 10**9 // k for k in range(1, 2048)}, 2048)
    assert len(plan.key) < 100_000 and len(plan.rooms) < 5_000
