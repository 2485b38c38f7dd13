"""Exact n-gram Jaccard self-join by parity sketches.

A document is the set of its distinct k-word shingles (A-Z lower-cased; fewer words: the whole sequence as one; none: empty, never
linked). Two sets of a and b shingles link when den * |intersection| >= num * |union|, so |A xor B| <= (a + b)(den - num)/(den + num).

Documents with equal sets form one class; everything below works on classes. Sizes are cut into bands such that linked sets lie in
the same or in neighbouring bands. Per band a sketch has a fixed number of blocks; every shingle XORs its 64-bit hash into the block
its hash selects, so the number of differing blocks is at most |A xor B|, at most the band's largest allowed difference d for linked
sets. An empty block says nothing and is never a key. A set with f > d filled blocks agrees with every linked one in f - d filled
blocks at least, and may leave out its (f - d - 1) / 2 blocks of fewest shingles (at most s of them): still one agreeing block
remains, so an equality join on (band, block, content) finds every link that at least one such set has. The number of blocks is
chosen so that nearly all sets of the band fill more than d. Those that do not also write a second, finer partition, where the same
holds; and those that do not fill that one either write their d + 1 shingles of smallest hash, of which any two linked sets share
one. A class writes for its own band and for the next one.

Within a block group no list of pairs is formed at once. First every member is verified against one hub, the member with most shared
blocks; components of these links are formed. Only groups that still hold several components are joined with themselves, on rows of
different components whose sizes and parity sketches (their Hamming distance is at most |A xor B|) allow a link: 256 bits first, then
about one bit a shingle up to 4096, since 256 tell no long sets apart. Texts that share a long passage share many blocks; of groups
with the same members one is joined. Pairs inside one component change nothing and are never made. Candidates then meet by their
whole sketches of about one bit a shingle, which tell unrelated sets of any size apart, and what is left is verified on the whole
shingle sets, so nothing is approximate but the 64-bit hashes. For that, the set of the more frequent side of a pair travels once per CHUNK pairs, not once per pair.

Null or empty text: no shingles, linked with nothing, its own component. Rows with equal id and equal text count as one document in
drop_near_duplicates. Null ids take part in links; a component of null ids only has a null id. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHash, col, fresh, mix, shingle_hashes
from tidemark.llm.components import connected_components
from tidemark.session import materialise

SKETCH_WORDS = 4
NARROW_WORDS = 64     # a wide sketch inside a join
BUCKET_KEYS = 4_000_000
CHUNK = 256
PACKED_KEYS, SEEN = 500_000, 200_000  # held by a task at once


@dataclass(frozen=True)
class Likeness:
    """k-word shingles, linked from similarity num/den on."""
    k: int = 5
    num: int = 80
    den: int = 100

    def bands(self) -> np.ndarray:
        """Smallest size of every band."""
        at = [1]
        while at[-1] < 1 << 31:
            at.append(at[-1] * self.den // self.num + 1)
        return np.array(at, np.int64)

    def allowed(self, total: int) -> int:
        """Largest symmetric difference of linked sets whose sizes add up to `total`."""
        return total * (self.den - self.num) // (self.den + self.num)


def _frame(text: Iterator[pd.Series], k: int) -> Iterator[tuple[pd.Series, list[np.ndarray]]]:
    words = WordHash()
    for t in text:
        yield t, [shingle_hashes(x, k, words) for x in t]


def signature(h: np.ndarray) -> int:
    return int(xxhash.xxh64_intdigest(h.tobytes())) - (1 << 63)


def parity_bits(h: np.ndarray) -> np.ndarray:
    """256-bit sketch as four signed words: every shingle flips one bit."""
    bits = np.bincount((mix(h ^ np.uint64(0xA5A5A5A5)) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def wide_parity(h: np.ndarray) -> bytes:
    """Parity sketch of one bit a shingle at least, a power of two of bits; halves XOR to the sketch of half the bits."""
    size = max(256, 1 << (len(h) - 1).bit_length())
    bits = np.bincount((mix(h ^ np.uint64(0x3C6EF372)) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def wide_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two wide sketches, the longer one folded; at most the symmetric difference of the sets."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def narrow_words(wide: bytes) -> np.ndarray:
    """A wide sketch as signed words, folded to NARROW_WORDS of them at most."""
    a = np.frombuffer(wide, np.int64)
    while len(a) > NARROW_WORDS:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def narrow_distance(x: Column, y: Column) -> Column:
    """Hamming distance of two narrowed sketches, the one of twice the words folded; 0 where lengths lie further apart."""
    n = F.least(F.size(x), F.size(y))

    def folded(c: Column) -> Column:
        return F.when(F.size(c) > n, F.zip_with(F.slice(c, 1, n), F.slice(c, n + 1, n), lambda a, b: a.bitwiseXOR(b))).otherwise(c)

    bits = F.aggregate(F.zip_with(folded(x), folded(y), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)
    return F.when(F.greatest(F.size(x), F.size(y)) <= 2 * n, bits).otherwise(0)


def _block_values(h: np.ndarray, band: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of shingles) of every block of a sorted shingle set in one band."""
    owner = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)  # rises with h
    ends = np.searchsorted(owner, np.arange(blocks + 1, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(h + np.uint64(0x5851F42D)))])
    value, size = total[ends[1:]] ^ total[ends[:-1]], np.diff(ends)
    return mix(value ^ mix(np.arange(blocks, dtype=np.uint64) + np.uint64((band + 1) << 32))), size


def block_keys(h: np.ndarray, band: int, blocks: int, skip: int) -> np.ndarray:
    """Keys of a sorted shingle set's blocks in one band, without the `skip` blocks of fewest shingles."""
    key, size = _block_values(h, band, blocks)
    return key[np.lexsort((key, size))[skip:]] if skip else key


@dataclass(frozen=True)
class Partition:
    """How sets write keys for one band: its largest allowed difference, blocks of the two partitions, blocks that may be left out."""
    d: int
    coarse: int
    fine: int
    spare: int


def partition(d: int, fewest: int) -> Partition:
    """Blocks such that sets of `fewest` shingles or more fill more than d of them, by a margin of two standard deviations where possible."""
    spare = -(-(d + 1) // 50)

    def filled(blocks: int) -> float:
        empty = np.exp(-fewest / blocks)
        return blocks * (1 - empty) - 2 * np.sqrt(blocks * empty)

    coarse = d + 1 + 2 * spare
    while filled(coarse) < d + 1 + 2 * spare and coarse < 2 * d + 2:
        coarse += 1 + coarse // 50
    return Partition(d, coarse, 3 * coarse, spare)


def filled_keys(h: np.ndarray, band: int, p: Partition) -> np.ndarray:
    """The keys of a sorted shingle set in one band; any two sets that differ in at most p.d shingles share one."""
    out = []
    for level, blocks in enumerate((p.coarse, p.fine)):
        key, size = _block_values(h, band + (level << 16), blocks)
        filled = np.flatnonzero(size)
        left_out = max(0, min(p.spare, (len(filled) - p.d - 1) // 2))
        if left_out:
            filled = filled[np.lexsort((key[filled], size[filled]))[left_out:]]
        out.append(key[filled])
        if np.count_nonzero(size) > p.d:
            return np.concatenate(out)
    single = np.sort(mix(h + np.uint64(0x2545F491)))[:p.d + 1]
    return np.concatenate([*out, mix(single ^ mix(np.full(1, (band + 1 + (2 << 16)) << 32, np.uint64)))])


def _prints(docs: DataFrame, like: Likeness, id_col: str, text_col: str) -> DataFrame:
    """doc_id, th (hash of the text), n, sig, s0..s3, wide of every row."""
    k = like.k
    fields = ", ".join(f"s{i} long" for i in range(SKETCH_WORDS))

    @F.pandas_udf(f"n long, sig long, {fields}, wide binary")
    def printed(text: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for _, sets in _frame(text, k):
            bits = np.array([parity_bits(h) for h in sets]).reshape(-1, SKETCH_WORDS)
            yield pd.DataFrame({"n": [len(h) for h in sets], "sig": [signature(h) for h in sets], **{f"s{i}": bits[:, i] for i in range(SKETCH_WORDS)},
                                "wide": [wide_parity(h) if len(h) else b"" for h in sets]})

    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("th"), printed(text).alias("p")).select("doc_id", "th", "p.*")


def _shared_blocks(docs: DataFrame, like: Likeness, text_col: str, shingles: int) -> DataFrame:
    """(key, sig): the blocks that at least two classes share.

    Blocks travel as packed arrays, one row per batch and bucket; a bucket holds a bounded number of keys on average and all rows of
    a key. Copies of one set write their blocks once per task.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, int(shingles * 3 * (like.den - like.num) / like.num / BUCKET_KEYS) + 1)
    edges = like.bands()
    plan = [partition(like.allowed(2 * (int(hi) - 1)), int(edges[max(0, j - 1)])) for j, hi in enumerate(edges[1:])]
    k = like.k

    def packed_rows(keys: list[np.ndarray], sigs: list[np.ndarray]) -> pd.DataFrame:
        key, sig = np.concatenate(keys), np.concatenate(sigs)
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        rows = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        return pd.DataFrame({"bucket": [int(bucket[r[0]]) for r in rows], "keys": [key[r].tobytes() for r in rows], "sigs": [sig[r].tobytes() for r in rows]})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, words = set(), WordHash()
        keys, sigs, held = [], [], 0
        for batch in batches:
            for text in batch["text"]:
                h = shingle_hashes(text, k, words)
                sig = signature(h) if len(h) else None
                if sig is None or sig in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(sig)
                own = int(np.searchsorted(edges, len(h), "right")) - 1
                for band in (own, own + 1):
                    if plan[band].d:
                        keys.append(filled_keys(h, band, plan[band]))
                        sigs.append(np.full(len(keys[-1]), sig, np.int64))
                        held += len(keys[-1])
                if held >= PACKED_KEYS:
                    yield packed_rows(keys, sigs)
                    keys, sigs, held = [], [], 0
        if keys:
            yield packed_rows(keys, sigs)

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(group["keys"]), np.uint64)
        sig = np.frombuffer(b"".join(group["sigs"]), np.int64)
        order = np.lexsort((sig, key))
        key, sig = key[order], sig[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
        key, sig = key[first], sig[first]
        same = key[1:] == key[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        return pd.DataFrame({"key": key[keep].view(np.int64), "sig": sig[keep]})

    packed = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInPandas(write, "bucket int, keys binary, sigs binary")
    return packed.groupBy("bucket").applyInPandas(shared, "key long, sig long")


def _alike(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose sizes and wide sketches allow a link."""
    def side(c: str) -> DataFrame:
        return classes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}"))

    @F.pandas_udf("long")
    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([wide_distance(u, v) for u, v in zip(x, y, strict=True)], dtype="int64")

    sized = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("na") * like.den >= F.col("nb") * like.num) & (F.col("nb") * like.den >= F.col("na") * like.num))
    return sized.where(distance("wa", "wb") * (like.den + like.num) <= (F.col("na") + F.col("nb")) * (like.den - like.num)).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, like: Likeness, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes that link, by their whole sets.

    The side of a pair that is in more pairs leads it. Pairs of one leader go in chunks: its set comes once per chunk, the other
    side's set with its pair.
    """
    pairs = materialise(_alike(pairs, classes, like), "alike_pairs")
    ends = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig")))
    degree = ends.groupBy("sig").agg(F.count("*").alias("degree"))
    sets = materialise(_sets(docs, classes.join(degree, "sig", "left_semi"), like, id_col, text_col), "sets")
    d = [degree.select(F.col("sig").alias(c), F.col("degree").alias(f"d{c}")) for c in "ab"]
    a_leads = F.col("da") >= F.col("db")
    led = pairs.join(d[0], "a").join(d[1], "b").select(
        F.when(a_leads, F.col("a")).otherwise(F.col("b")).alias("lead"), F.when(a_leads, F.col("b")).otherwise(F.col("a")).alias("other"), F.greatest("da", "db").alias("chunks"))
    led = led.select("lead", "other", F.pmod(F.xxhash64("other"), (F.col("chunks") / CHUNK).cast("long") + 1).alias("chunk"))
    heads = led.select("lead", "chunk").distinct().join(sets.withColumnRenamed("sig", "lead"), "lead").select("lead", "chunk", F.lit(None).cast("long").alias("other"), "h")
    members = led.join(sets.withColumnRenamed("sig", "other"), "other").select("lead", "chunk", "other", "h")
    rows = heads.union(members).repartition("lead", "chunk").sortWithinPartitions("lead", "chunk", F.col("other").asc_nulls_first())

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = np.empty(0, np.int64)
        for batch in batches:
            out = []
            for lead, other, h in zip(batch["lead"], batch["other"], batch["h"], strict=True):
                if pd.isna(other):
                    head = np.asarray(h)
                    continue
                both = len(np.intersect1d(head, np.asarray(h), assume_unique=True))
                if both * like.den >= (len(head) + len(h) - both) * like.num:
                    out.append((lead, int(other)))
            yield pd.DataFrame(out, columns=["lead", "other"])

    # ids of 64 bits do not survive in a float column, so the members' column is sent as text
    linked = rows.withColumn("other", F.col("other").cast("string")).mapInPandas(compare, "lead long, other long")
    return linked.select(*_pair("lead", "other"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _open_keys(member: DataFrame) -> DataFrame:
    """(key): one of the blocks with the same members, if these lie in several components. member: key, sig, comp, a class once a key."""
    groups = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("sig")).alias("list"))
    return groups.where("lo < hi").groupBy("size", "list").agg(F.min("key").alias("key")).select("key")


def link_classes(docs: DataFrame, prints: DataFrame, like: Likeness, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes, links). classes: sig, n, doc_id and th of its first document, sketch; links: pairs of sigs.

    The links are verified and join the classes of a component; links between classes that are already joined are left out.
    """
    sketch = [f"s{i}" for i in range(SKETCH_WORDS)]
    classes = materialise(prints.where("n > 0").groupBy("sig").agg(
        F.min("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first"), *(F.min(s).alias(s) for s in sketch),
        F.first("wide").alias("wide")), "classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    members = materialise(_shared_blocks(docs, like, text_col, shingles), "shared_blocks")

    degree = members.groupBy("sig").agg(F.count("*").alias("degree"))
    hub = members.join(degree, "sig").groupBy("key").agg(F.max(F.struct("degree", "sig"))["sig"].alias("hub"))
    near = materialise(members.join(hub, "key").where("sig <> hub").select(*_pair("sig", "hub")).distinct(), "hub_pairs")
    first = materialise(_verified(near, docs, classes, like, id_col, text_col), "hub_links")

    root = connected_components(first).withColumnsRenamed({"node": "sig", "root": "comp"})
    member = members.join(root, "sig", "left").select("key", "sig", F.coalesce("comp", "sig").alias("comp"))
    member = materialise(member, "members")

    @F.pandas_udf("array<long>")
    def narrow(wide: pd.Series) -> pd.Series:
        return pd.Series([narrow_words(w) for w in wide], dtype=object)

    rest = member.join(_open_keys(member), "key", "left_semi").join(classes.select("sig", "n", *sketch, narrow("wide").alias("words")), "sig")
    x, y = (rest.select(*(F.col(c).alias(f"{p}{c}") for c in ["key", "sig", "comp", "n", *sketch, "words"])) for p in "xy")
    differ = sum((F.bit_count(F.col(f"x{s}").bitwiseXOR(F.col(f"y{s}"))) for s in sketch), F.lit(0))
    may = ((F.col("xcomp") < F.col("ycomp")) & (F.col("xn") * like.den >= F.col("yn") * like.num) & (F.col("yn") * like.den >= F.col("xn") * like.num)
           & (differ * (like.den + like.num) <= (F.col("xn") + F.col("yn")) * (like.den - like.num))
           & (narrow_distance(F.col("xwords"), F.col("ywords")) * (like.den + like.num) <= (F.col("xn") + F.col("yn")) * (like.den - like.num)))
    far = x.join(y, (F.col("xkey") == F.col("ykey")) & may).select(*_pair("xsig", "ysig")).distinct().join(near, ["a", "b"], "left_anti")
    second = materialise(_verified(materialise(far, "rest_pairs"), docs, classes, like, id_col, text_col), "rest_links")
    return classes, first.union(second)


def _sets(docs: DataFrame, wanted: DataFrame, like: Likeness, id_col: str, text_col: str) -> DataFrame:
    """(sig, h): whole shingle sets of the wanted classes, from the first document of each."""
    k = like.k

    @F.pandas_udf("array<long>")
    def hashes(text: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for _, sets in _frame(text, k):
            yield pd.Series([h.view(np.int64) for h in sets])

    text = F.col(f"`{text_col}`").cast("string")
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    w = wanted.select("sig", F.col("first.doc_id").alias("id"), F.col("first.th").alias("want"))
    found = d.join(w, d["doc_id"].eqNullSafe(w["id"]) & (d["th"] == w["want"])).select("sig", "text")
    return found.groupBy("sig").agg(F.first("text").alias("text")).select("sig", hashes("text").alias("h"))


def _components(docs: DataFrame, like: Likeness, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(prints, per class: sig, comp, first document of the component)."""
    prints = materialise(_prints(docs, like, id_col, text_col), "prints")
    classes, links = link_classes(docs, prints, like, id_col, text_col)
    root = connected_components(links).withColumnsRenamed({"node": "sig", "root": "comp"})
    by_class = classes.select("sig", "first").join(root, "sig", "left").select("sig", "first", F.coalesce("comp", "sig").alias("comp"))
    head = by_class.groupBy("comp").agg(F.min("first").alias("head"), F.min("first.doc_id").alias("component_id"))
    return prints, materialise(by_class.select("sig", "comp").join(head, "comp"), "class_components")


def near_duplicate_components(docs: DataFrame, like: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links; a document without shingles is its own) of every row."""
    prints, comps = _components(docs, like, id_col, text_col)
    own = prints.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return prints.where("n > 0").join(comps, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(own)


def drop_near_duplicates(docs: DataFrame, like: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per component, that of its smallest id (equal ids: smallest text hash), and every document without shingles.

    Columns stay as they are. Rows of equal id and text count as one.
    """
    prints, comps = _components(docs, like, id_col, text_col)
    keep = comps.select(F.col("head.doc_id").alias("id"), F.col("head.th").alias("want")).distinct()
    keep = materialise(keep.union(prints.where("n = 0").select("doc_id", "th")).distinct(), "kept")
    th = fresh(docs, "th")
    d = docs.withColumn(th, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    kept = d.join(keep, col(d, id_col).eqNullSafe(keep["id"]) & (col(d, th) == keep["want"]), "left_semi")
    return kept.dropDuplicates([id_col, th]).select(*(col(docs, c) for c in docs.columns))
