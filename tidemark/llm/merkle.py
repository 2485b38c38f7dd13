"""Merkle manifest of a dataset by time-forward processing.

H is SHA-256 in lower-case hex of its inputs written one after another (digests as hex text). A row is a leaf; within a source leaves
ascend by id; while a level has several nodes, every `FAN` consecutive ones become their parent (the last run may have fewer). What
remains is the source's subroot; subroots, ordered by source, give the root in the same way.

Nodes are labelled (round, group, block, level, index), in the order in which their inputs are ready. A priority queue ordered by
label carries the digests forward: a node takes the messages of its label from the queue, hashes them and sends its own digest to
its parent's label. The external part of the queue is Spark's sorted shuffle: it brings the nodes of one block (FAN ** LEVELS
consecutive ones of a group) together, a heap inside the task delivers the messages within the block, and only the digest at the top
of each block goes on to the next round, a table FAN ** LEVELS times smaller. The reversed sweep goes through the rounds and labels
backwards: a parent delivers to its children what its own proof is (the proof suffix) and their siblings. One suffix travels to a
block, not to a node.

Proofs are checked by folding: a leaf, possibly recomputed from a changed text, is hashed with the original siblings up to a root.

A leaf's place in its source comes from a range-partitioned sort by (source, id, leaf) and running counts per task, so a source
that holds a third of all rows, or all, is spread over tasks like any other. Only digests are sorted and shuffled, never texts.

Null fields are written `-` in the leaf; a null source is a group of its own, before all others; null ids come first; a null text
stays null when tampered with. Empty texts are `0:`. Texts of any length are hashed whole. Equal ids are ordered by their leaves; equal
rows are leaves of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

FAN, LEVELS = 3, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
Step = tuple[str, str]  # siblings left and right of a node
NODE = "grp string, place long, total long, digest string"


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each `-` if null, else byte count, colon, value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def _hash(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels of hashing until n nodes are one."""
    d = 0
    while n > 1:
        n, d = -(-n // FAN), d + 1
    return d


def forward(digests: list[str], levels: int) -> list[list[str]]:
    """Digests of every level of one block, from its own nodes up; messages are delivered in label order by a heap."""
    out = [list(digests)] + [[] for _ in range(levels)]
    queue = [(1, i // FAN, i, d) for i, d in enumerate(digests)] if levels else []  # (level, index of the receiver, sender, digest)
    heapq.heapify(queue)
    while queue:
        level, index = queue[0][:2]
        parts = []
        while queue and queue[0][:2] == (level, index):
            parts.append(heapq.heappop(queue)[3])
        own = _hash(parts)
        out[level].append(own)
        if level < levels:
            heapq.heappush(queue, (level + 1, index // FAN, index, own))
    return out


def backward(tree: list[list[str]], suffix: list[Step]) -> list[list[Step]]:
    """Proof (siblings per level, upwards) of every node of a block, from the proof of the block's top."""
    proofs = [suffix]
    for nodes in reversed(tree[:-1]):
        below = []
        for i in range(len(nodes)):
            first = i - i % FAN
            below.append([("".join(nodes[first:i]), "".join(nodes[i + 1:first + FAN])), *proofs[i // FAN]])
        proofs = below
    return proofs


def fold(digest: str, proof: list[Step]) -> str:
    """The root that a node's digest gives with these siblings."""
    for left, right in proof:
        digest = _hash([left, digest, right])
    return digest


def _packed(proof: list[Step]) -> str:
    return ";".join(f"{a},{b}" for a, b in proof)


def _unpacked(proof: str) -> list[Step]:
    return [tuple(x.split(",")) for x in proof.split(";")] if proof else []


def _blocks(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of equal keys from sorted batches; a key may go over batches."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        new = (b[keys] != b[keys].shift()).any(axis=1).to_numpy()
        new[0] = not held or (held[-1][keys].iloc[-1] != b[keys].iloc[0]).any()
        starts = [i for i, x in enumerate(new) if x]
        if not starts:
            held.append(b)
            continue
        if starts[0]:
            held.append(b.iloc[:starts[0]])
        for a, z in zip(starts, [*starts[1:], len(b)], strict=True):
            if held:
                yield pd.concat(held) if len(held) > 1 else held[0]
            held = [b.iloc[a:z]]
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    d = nodes.withColumn("block", F.expr(f"place div {FAN ** levels}"))
    return d.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top of every block, as the nodes of the next round."""
    def up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for b in _blocks(batches, ["grp", "block"]):
            total = int(b["total"].iloc[0])
            tree = forward(b["digest"].tolist(), min(levels, depth(total)))
            rows.append((b["grp"].iloc[0], int(b["block"].iloc[0]), -(-total // FAN ** levels), tree[-1][0]))
            if len(rows) == 10_000:
                yield pd.DataFrame(rows, columns=["grp", "place", "total", "digest"])
                rows = []
        yield pd.DataFrame(rows, columns=["grp", "place", "total", "digest"])

    return _in_blocks(nodes, levels).mapInPandas(up, NODE)


def _rounds(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Stored nodes of every round, from the leaves to one node per group."""
    rounds = [leaves]
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > 1:
        rounds.append(materialise(_tops(rounds[-1].select("grp", "place", "total", "digest"), levels), "merkle_nodes"))
    return rounds


def _with_suffixes(nodes: DataFrame, tops: DataFrame, extra: list[str], levels: int) -> DataFrame:
    """Nodes and, before them, one row per block with its top's suffix, sorted for the reversed sweep. tops: grp, place, suffix, subroot."""
    n = FAN ** levels
    blank = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in ["digest", *extra]]
    lead = tops.select("grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("total"), "suffix", "subroot", *blank)
    own = nodes.select("grp", F.expr(f"place div {n}").alias("block"), "place", "total", F.lit(None).cast("string").alias("suffix"), F.lit(None).cast("string").alias("subroot"), "digest", *extra)
    return lead.unionByName(own).repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _proofs(b: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, list[list[Step]], str]:
    """(the block's nodes, their proofs, subroot)."""
    lead, nodes = b.iloc[0], b.iloc[1:]
    tree = forward(nodes["digest"].tolist(), min(levels, depth(int(nodes["total"].iloc[0]))))
    return nodes, backward(tree, _unpacked(lead["suffix"])), lead["subroot"]


def _down(nodes: DataFrame, tops: DataFrame, levels: int) -> DataFrame:
    """grp, place, suffix, subroot of every node of a round, from those of the round above."""
    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _blocks(batches, ["grp", "block"]):
            nodes, proofs, subroot = _proofs(b, levels)
            yield pd.DataFrame({"grp": nodes["grp"].array, "place": nodes["place"].array, "suffix": [_packed(p) for p in proofs], "subroot": subroot})

    return _with_suffixes(nodes, tops, [], levels).mapInPandas(sweep, "grp string, place long, suffix string, subroot string")


def _placed(rows: DataFrame, group: Column, order: list[str], name: str) -> DataFrame:
    """rows with grp, place (from 0 in the group, in the given order) and total (rows of the group), stored."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("grp", group)
    by = ["grp", *order]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not len(b):
                continue
            local = b.groupby("grp", sort=False).cumcount().to_numpy()
            own = b["grp"].to_numpy()
            if last is not None and own[0] == last:
                local = local + seen * (own == last)
            last, seen = own[-1], int(local[-1]) + 1
            yield b.assign(part=part, local=local)

    counted = materialise(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInPandas(count, f"{columns}, part int, local long"), name)
    counts = counted.groupBy("part", "grp").agg(F.count("*").alias("number"))
    w = Window.partitionBy("grp")
    base = counts.select("part", "grp", F.sum("number").over(w).alias("total"), (F.sum("number").over(w.orderBy("part")) - F.col("number")).alias("base"))
    return counted.join(base, ["part", "grp"]).withColumn("place", F.col("base") + F.col("local")).drop("part", "local", "base", "number")


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text",
             levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    tampered: the text to fold instead of the own one (a column over docs); none: the own text is folded. A block of one round has at
    most FAN ** levels nodes; the result does not depend on it.
    """
    plain = [F.col(f"`{f}`") for f in fields]
    own = leaf_digest(plain)
    changed = own if tampered is None else F.when(tampered.eqNullSafe(F.col(f"`{text_col}`")), own).otherwise(leaf_digest([tampered if f == text_col else c for f, c in zip(fields, plain, strict=True)]))
    source = F.col(f"`{group_col}`").cast("string")
    thin = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), source)).alias("src"), own.alias("digest"), changed.alias("folded"))
    thin = materialise(thin, "merkle_leaves")
    leaves = materialise(_placed(thin, F.col("src"), ["doc_id", "digest", "folded"], "merkle_sorted").drop("src"), "merkle_places")

    rounds = _rounds(leaves, levels)
    subroots = rounds[-1].select(F.col("grp").alias("src"), "digest")
    over = materialise(_placed(subroots, F.lit(""), ["src"], "merkle_subroots"), "merkle_subroot_places")
    upper = _rounds(over, levels)
    top = upper[-1].first()
    if top is None:
        return leaves.select("doc_id", *(F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), F.lit(True).alias("verified"))
    root = top["digest"]

    known = upper[-1].select("grp", "place", F.lit("").alias("suffix"), F.lit("").alias("subroot"))
    for nodes in reversed(upper[:-1]):
        known = materialise(_down(nodes, known, levels), "merkle_suffixes")
    known = over.join(known.select("place", "suffix"), "place").select(F.col("src").alias("grp"), F.lit(0).cast("long").alias("place"), "suffix", F.col("digest").alias("subroot"))
    for nodes in reversed(rounds[1:-1]):
        known = materialise(_down(nodes, known, levels), "merkle_suffixes")

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _blocks(batches, ["grp", "block"]):
            nodes, proofs, subroot = _proofs(b, levels)
            folded = [fold(d, p) for d, p in zip(nodes["folded"], proofs, strict=True)]
            yield pd.DataFrame({
                "doc_id": nodes["doc_id"].astype("Int64").array, "leaf": nodes["digest"].array, "subroot": subroot, "root": root,
                "proof_sha256": [_hash([x for step in p for x in step]) for p in proofs], "folded_root": folded, "verified": [f == root for f in folded]})

    swept = _with_suffixes(leaves, known, ["doc_id", "folded"], levels)
    return swept.mapInPandas(last, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
