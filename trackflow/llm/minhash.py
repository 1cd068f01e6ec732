"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A signature holds ``SLOTS`` minima of 16 bits. Its slots are cut into chunks of ``WIDTH``; of two signatures that differ in at most
chunks * (ERRORS + 1) - 1 slots, some chunk differs in at most ERRORS, so they share one of the keys that leave ERRORS slots of a chunk
out. With the defaults that is 23 of 48 slots: two sets alike in exactly 0.8 differ in more once in about 300,000 pairs, more
alike ones much more seldom. No pair within that distance is lost, and every link is confirmed on the full sets.

Keys of large groups are never expanded into pairs. First each set is compared with one centre, the first member of the keys it
shares most; that joins most of a group. Keys whose members are then still apart are settled exactly: small
ones by their open pairs, large ones in tiles of bounded size that return a spanning forest of confirmed links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.graph import components
from trackflow.llm.simhash import shingle_hashes
from trackflow.llm.work import map_rows, ready, staged

SLOTS, WIDTH, ERRORS = 48, 4, 1
REACH = SLOTS // WIDTH * (ERRORS + 1) - 1
#: Members of a key that meet as pairs of rows; more meet in tiles of so many rows and bytes of sets.
FEW = 16
TILE_ROWS = 1024
TILE_BYTES = 8 << 20
#: Sets that one task compares with one centre.
SPLIT = 4096

_RNG = np.random.default_rng(13)
_FLIP = _RNG.integers(0, 1 << 64, SLOTS, dtype=np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def signature(own: np.ndarray) -> bytes:
    """16 bits of the minimum of every permutation of the distinct hashes of a set."""
    least = np.full(SLOTS, np.uint64((1 << 64) - 1))
    for i in range(0, len(own), 4096):
        part = (own[None, i : i + 4096] ^ _FLIP[:, None]) * _TIMES[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least * _MIX) >> np.uint64(48)).astype("<u2").tobytes()


def elements(own: np.ndarray) -> bytes:
    """The set as sorted 32-bit numbers, by which sets are compared; its size is counted before that."""
    return (own >> np.uint64(32)).astype(np.uint32).tobytes()


def set_hash(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each row of slots, the keys of all chunks with ERRORS slots left out, as signed longs."""
    slots = signatures.astype(np.uint64)
    keys = []
    for start in range(0, SLOTS, WIDTH):
        for left in itertools.combinations(range(WIDTH), WIDTH - ERRORS):
            key = np.full(len(slots), np.uint64(len(keys)))
            for at in left:
                key = (key << np.uint64(16)) ^ slots[:, start + at] if WIDTH - ERRORS <= 3 else (key ^ slots[:, start + at]) * _MIX
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def alike(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets share ``similarity`` of their union or more; per cent, so that the comparison is exact."""
    few, many = (one, other) if len(one) < len(other) else (other, one)
    percent = round(100 * similarity)
    if not len(few) or 100 * len(few) < percent * len(many):
        return False
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    shared = int((many[at] == few).sum())
    return 100 * shared >= percent * (len(few) + len(many) - shared)


def confirmed(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) from rows ``centre``, ``salt``, ``node``, ``elements``: the centre's own row is compared with all others of its salt.

    A task reads its rows in order and holds one centre at a time.
    """
    ready(rows.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.zeros(0, dtype=np.uint32)
        for batch in batches:
            found = []
            for centre, salt, mine, node, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                other = np.frombuffer(x, np.uint32)
                if mine:
                    now, own = (centre, salt), other
                elif now == (centre, salt) and alike(own, other, similarity):
                    found.append((centre, node))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in (0, 1)], schema=schema)

    dealt = rows.select("centre", "salt", (F.col("centre") == F.col("node")).alias("mine"), "node", "elements")
    return dealt.repartition("centre", "salt").sortWithinPartitions("centre", "salt", F.desc("mine")).mapInArrow(fn, "a long, b long")


def tile_forest(label: np.ndarray, far: np.ndarray | None, slots: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Confirmed links that join the labels as all links within reach do; with ``far``, only links between its two sides count."""
    label = np.unique(label, return_inverse=True)[1]
    largest = np.bincount(label).argmax()
    links = []
    for i in np.flatnonzero(label != largest):  # of two labels, one is not the largest
        open_ = (label != label[i]) & ((slots != slots[i]).sum(axis=1) <= REACH)
        if far is not None:
            open_ &= far != far[i]
        for j in np.flatnonzero(open_):
            if label[j] != label[i] and alike(sets[i], sets[j], similarity):
                links.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return links


def from_centres(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows for ``confirmed`` from links (a, b) of any number for one a, which is repeated for every ``SPLIT`` of them."""
    splits = staged(pairs.groupBy("a").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("splits")), "splits")
    members = pairs.join(splits, "a").select(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), F.col("splits")).cast("int").alias("salt"), F.col("b").alias("node"))
    own = splits.select(F.col("a").alias("centre"), F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("salt"), F.col("a").alias("node"))
    return members.unionByName(own).join(sets.select("node", "elements"), "node")


def open_links(shared: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float, few: int = FEW, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that join the components in ``labels`` as all alike sets that share a key do.

    ``shared``: key, node; ``labels``: id, component (a node missing there is its own); ``sets``: node, n, sig, elements. All stored.
    """
    of_node = labels.select(F.col("id").alias("node"), "component")
    rows = staged(shared.join(of_node, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label")), "labelled")
    once, twice = F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64(F.lit(1), "node"))
    apart = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"), once.alias("x"), twice.alias("y"))
    # of keys with the same members, one is enough
    apart = apart.where("low <> high").groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key", "members")
    live = staged(rows.join(apart, "key").join(sets.select("node", "n"), "node"), "open")

    left, right = (live.where(F.col("members") <= few).select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "n"))) for s in "ab")
    able = 100 * F.least("n_a", "n_b") >= round(100 * similarity) * F.greatest("n_a", "n_b")
    pairs = left.join(right, "key").where((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & able)
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("sig").alias("one")), "a").join(sets.select(F.col("node").alias("b"), F.col("sig").alias("other")), "b")

    def within(a: list, b: list, one: list, other: list) -> list:
        near = [k for k, (x, y) in enumerate(zip(one, other, strict=True)) if (np.frombuffer(x, "<u2") != np.frombuffer(y, "<u2")).sum() <= REACH]
        return [[a[k] for k in near], [b[k] for k in near]]

    pairs = staged(map_rows(both.select("a", "b", "one", "other"), within, "a long, b long"), "pairs")
    single = confirmed(from_centres(pairs, sets), similarity)

    large = live.where(F.col("members") > few)
    sizes = large.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / tile_rows), F.ceil(F.sum(4 * F.col("n")) / TILE_BYTES)).cast("int").alias("tiles"))
    dealt = large.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("key", F.least("tile", "facing").alias("tile_a"), F.greatest("tile", "facing").alias("tile_b"), "tile", "node", "label")
    dealt = dealt.join(sets.select("node", "sig", "elements"), "node")

    def compare(rows: pa.Table) -> pa.Table:
        ids, tile = rows["node"].to_numpy(), rows["tile"].to_numpy()
        far = None if rows["tile_a"][0] == rows["tile_b"][0] else tile == tile[0]
        slots = np.stack([np.frombuffer(x, "<u2") for x in rows["sig"].to_pylist()])
        found = tile_forest(rows["label"].to_numpy(), far, slots, [np.frombuffer(x, np.uint32) for x in rows["elements"].to_pylist()], similarity)
        return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

    ready(sets.sparkSession)
    return single.unionByName(dealt.groupBy("key", "tile_a", "tile_b").applyInArrow(compare, "a long, b long"))


def shared_keys(nodes: DataFrame) -> DataFrame:
    """``key``, ``node`` and ``centre`` (the first member) of all keys that more than one node has."""

    def fn(ids: list, sigs: list) -> list:
        keys = chunk_keys(np.frombuffer(b"".join(sigs), "<u2").reshape(len(sigs), SLOTS))
        return [ids, list(keys)]

    rows = map_rows(nodes.select("node", "sig"), fn, "node long, keys array<long>").select("node", F.explode("keys").alias("key"))
    first = rows.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").drop("last")
    return rows.join(first, "key").select("key", "node", "centre")


def minhash_groups(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component``, the smallest id reachable over texts alike by Jaccard in ``similarity`` or more.

    Equal sets of shingles are one node, so copies add no links. Null texts and texts without words have no shingles and are
    linked with nothing. One row for each input row, repeated ids and rows included; a null id has the component of its equals, if
    any, else null. Sets are compared as 32-bit hashes. Empty tables give no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def marks(ids: list, texts: list) -> list:
        own = [np.unique(shingle_hashes(t, shingle_words)) for t in texts]
        return [ids, [len(x) for x in own], [set_hash(x) if len(x) else None for x in own], [signature(x) if len(x) else None for x in own]]

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = staged(map_rows(source, marks, f"doc_id {id_type}, n_shingles long, hash binary, sig binary"), "signatures")
    able = marked.where("hash IS NOT NULL AND doc_id IS NOT NULL")
    nodes = able.groupBy("hash").agg(F.min("doc_id").alias("first"), F.min("n_shingles").alias("n"), F.min("sig").alias("sig"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    shared = staged(shared_keys(nodes), "shared")
    votes = shared.where("node <> centre").groupBy("node", "centre").count()
    best = staged(votes.groupBy("node").agg(F.max_by("centre", F.struct("count", -F.col("centre"))).alias("centre")), "centres")
    splits = staged(best.groupBy("centre").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("splits")), "splits")
    # all that a set needs to find its places, so that it is shuffled once: its centre and that one's splits, and its own splits
    placed = best.join(splits, "centre").withColumnRenamed("splits", "of_centre")
    places = shared.select("node").distinct().join(placed, "node", "left").join(splits.withColumnRenamed("centre", "node"), "node", "left")
    needed = places.join(nodes.select("node", "hash", "n", "sig", F.col("first").alias("doc_id")), "node")

    def cut(hashes: list, texts: list, *rest: list) -> list:
        own = [np.unique(shingle_hashes(t, shingle_words)) for t in texts]
        right = [k for k, (x, h) in enumerate(zip(own, hashes, strict=True)) if len(x) and set_hash(x) == h]  # an id may have other texts
        return [[elements(own[k]) for k in right], *([column[k] for k in right] for column in rest)]

    carried = "node", "n", "sig", "centre", "of_centre", "splits"
    sets = map_rows(source.join(needed, "doc_id").select("hash", "text", *carried), cut, "elements binary, node long, n long, sig binary, centre long, of_centre int, splits int")
    sets = staged(sets, "sets")

    as_member = F.when(F.col("centre").isNotNull(), F.array(F.struct("centre", F.pmod(F.xxhash64("node"), F.col("of_centre")).cast("int").alias("salt"))))
    as_centre = F.transform(F.sequence(F.lit(0), F.col("splits") - 1), lambda s: F.struct(F.col("node").alias("centre"), s.alias("salt")))
    none = F.expr("CAST(array() AS array<struct<centre: bigint, salt: int>>)")
    star = sets.select("node", "elements", F.explode(F.concat(F.coalesce(as_member, none), F.coalesce(as_centre, none))).alias("at")).select("at.*", "node", "elements")
    links = staged(confirmed(star, similarity), "links")
    rest = staged(open_links(shared.select("key", "node"), components(links), sets, similarity), "rest")

    found = components(links.unionByName(rest))
    rooted = staged(nodes.join(found.withColumnRenamed("id", "node"), "node", "left").select("hash", "first", F.coalesce("component", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    owned = staged(rooted.join(least, "root").select("hash", "least"), "owned")
    alone = F.when(F.col("hash").isNull(), F.col("doc_id"))
    return marked.join(owned, "hash", "left").select("doc_id", "n_shingles", F.coalesce("least", alone).alias("component"))
