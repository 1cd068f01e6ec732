"""SimHash fingerprints and their near duplicates, by tiled exact comparison.

Fingerprints are cells by the population counts of their two halves; two fingerprints differ in at least as many bits as
the counts of their halves differ, so only pairs of cells that can lie within the radius are compared, each cell cut into tiles of
bounded size. Inside a pair of tiles, strips sorted by the population counts of the quarters are compared with exclusive
or and bit counts, and strips too far apart are skipped. A pair of tiles returns a minimum spanning forest of its links,
closest first: the same components as all links, without the pairs of a group.

Where links between sets of very different sizes are of no use, cells are classes of sizes instead, and strips are sorted by
size first: that leaves far fewer pairs than population counts, which hardly tell fingerprints of prose apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.graph import components
from trackflow.llm.work import map_rows, ready, staged

SEED = 42
TILE = 32768
STRIP = 1024
#: Rows of a strip that are compared at once, so that the numbers between stay in the cache.
ROWS = 64


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; of the whole sequence if it is shorter; none without words."""
    parts = (text or "").encode().lower().split()  # both of ASCII only
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if over half of the hashes set it; zero without hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``fp`` (the fingerprint as a signed long) and ``n_shingles`` (distinct) of every whole text.

    A null text counts as empty: fingerprint zero, no shingles. One output row for each input row.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def fn(keys: list, texts: list) -> list:
        fps, sizes = [], []
        for t in texts:
            h = shingle_hashes(t, shingle_words)
            fp = fingerprint(h)
            fps.append(fp - (1 << 64) if fp >> 63 else fp)
            sizes.append(len(np.unique(h)))
        return [keys, fps, sizes]

    return map_rows(docs.select(id_col, text_col), fn, f"`{id_col}` {id_type}, fp long, n_shingles long")


def forest(n: int, i: np.ndarray, j: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Indices of links that make a minimum spanning forest of n nodes."""
    label, taken = np.arange(n), []
    for d in np.unique(bits):
        links = np.flatnonzero(bits == d)
        while len(links):
            a, b = label[i[links]], label[j[links]]
            open_ = a != b
            links, a, b = links[open_], a[open_], b[open_]
            if not len(links):
                break
            high, low = np.maximum(a, b), np.minimum(a, b)
            roots, first = np.unique(high, return_index=True)
            label[roots] = low[first]  # one link for each root that goes
            taken.append(links[first])
            while (label != label[label]).any():
                label = label[label]
    return np.concatenate(taken) if taken else np.zeros(0, dtype=np.int64)


def strips(fps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray, int, int]]]:
    """An order by size and the population counts of the quarters, and its strips with their smallest and largest counts and sizes."""
    counts = np.bitwise_count(fps.astype(">u8").view(np.uint8).reshape(-1, 4, 2)).sum(axis=2, dtype=np.int64)
    order = np.lexsort((counts[:, 2], counts[:, 0], sizes))
    counts, sizes = counts[order], sizes[order]
    cut = [(a, min(a + STRIP, len(fps))) for a in range(0, len(fps), STRIP)]
    return order, [(a, b, counts[a:b].min(axis=0), counts[a:b].max(axis=0), int(sizes[a]), int(sizes[b - 1])) for a, b in cut]


def within(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all pairs that differ in ``radius`` bits at most, and these bits."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    other = np.empty((ROWS, len(right)), dtype=np.uint64)
    bits = np.empty((ROWS, len(right)), dtype=np.uint8)
    for a in range(0, len(left), ROWS):
        rows = left[a : a + ROWS, None]
        own, count = other[: len(rows)], bits[: len(rows)]
        np.bitwise_count(np.bitwise_xor(rows, right, out=own), out=count)
        at = np.flatnonzero(count <= radius)
        if len(at):
            found.append((at + a * len(right), count.ravel()[at]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    at, near = (np.concatenate(x) for x in zip(*found, strict=True))
    return at // len(right), at % len(right), near


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int, sizes: tuple[np.ndarray, np.ndarray] | None = None, ratio: float = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of a spanning forest between two tiles, or inside one: positions in left and right, and bits that differ.

    With ``sizes`` of the rows of both, only pairs count whose smaller size is ``ratio`` of the larger one or more.
    """
    same = right is None
    right = left if same else right
    size_l, size_r = sizes or (np.zeros(len(left)), np.zeros(len(right)))
    order_l, strips_l = strips(left, size_l)
    order_r, strips_r = (order_l, strips_l) if same else strips(right, size_r)
    sorted_l, sorted_r, size_l, size_r = left[order_l], right[order_r], size_l[order_l], size_r[order_r]
    shift = 0 if same else len(left)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b, low, high, least, most in strips_l:
        for c, d, low_r, high_r, least_r, most_r in strips_r:
            if same and c < a or most < ratio * least_r or most_r < ratio * least:
                continue
            if np.maximum(np.maximum(low - high_r, low_r - high), 0).sum() > radius:
                continue
            i, j, own = within(sorted_l[a:b], sorted_r[c:d], radius)
            if same and a == c:
                once = i < j
                i, j, own = i[once], j[once], own[once]
            if ratio and len(i):
                one, other = size_l[a + i], size_r[c + j]
                able = np.minimum(one, other) >= ratio * np.maximum(one, other)
                i, j, own = i[able], j[able], own[able]
            if not len(i):
                continue
            kept = forest(b - a + d - c, i, (j if same and a == c else j + b - a), own)
            found.append((i[kept] + a, j[kept] + c, own[kept]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    i, j, bits = (np.concatenate(x) for x in zip(*found, strict=True))
    i, j = order_l[i], order_r[j]
    kept = forest(len(left) + (0 if same else len(right)), i, j + shift, bits)
    return i[kept], j[kept], bits[kept]


def near_links(nodes: DataFrame, radius: int, tile: int = TILE, ratio: float = 0) -> DataFrame:
    """Links (``a``, ``b``, ``bits``, ``size_a``, ``size_b``) of spanning forests of all pairs within the radius.

    ``ratio``: of those only whose smaller size is this share of the larger one or more.
    ``nodes``: ``id`` long, ``fp`` long, ``size`` long, from a stored table; at most 33 x 33 cell counts reach the driver, or one for
    each class of sizes. Nodes with a null id or fp are ignored, with ``ratio`` also those with a null size.
    """
    spark = ready(nodes.sparkSession)
    half = lambda bits: F.bit_count(F.shiftrightunsigned("fp", 32) if bits else F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    width = max(1, radius // 2)  # of a cell, in bits of a population count: wider cells mean fewer copies of a node
    cell = lambda bits: F.floor(half(bits) / width).cast("int")
    apart = lambda a, b: max(0, (abs(a - b) - 1) * width + 1)  # noqa: E731  # least difference of counts in two cells
    near = lambda one, other: apart(one[0], other[0]) + apart(one[1], other[1]) <= radius
    nodes = nodes.where("id IS NOT NULL AND fp IS NOT NULL")
    if ratio:
        step = max(-math.log(ratio), 0.001) * (1 + 1e-9)  # two sizes within the ratio are of one class or of neighbouring ones
        nodes = nodes.where("size IS NOT NULL").select("id", "fp", "size", F.floor(F.log(F.greatest("size", F.lit(1))) / step).cast("int").alias("high"), F.lit(0).alias("low"))
        near = lambda one, other: abs(one[0] - other[0]) <= 1
    else:
        nodes = nodes.select("id", "fp", "size", cell(1).alias("high"), cell(0).alias("low"))
    cells = {(r[0], r[1]): -(-r[2] // tile) for r in nodes.groupBy("high", "low").count().collect()}
    order = {c: k for k, c in enumerate(sorted(cells))}
    meets = []  # of a cell: the pair of cells, its side, and into how many tiles both are cut
    for (h, w), n in cells.items():
        for (h2, w2), n2 in cells.items():
            if order[h, w] <= order[h2, w2] and near((h, w), (h2, w2)):
                pair = order[h, w], order[h2, w2]
                meets.append((h, w, *pair, 0, n, n2))
                if pair[0] != pair[1]:
                    meets.append((h2, w2, *pair, 1, n2, n))
                elif n > 1:
                    meets.append((h2, w2, *pair, 1, n, n))
    partners = spark.createDataFrame(meets, "high int, low int, cell_a int, cell_b int, side int, own int, other int")
    # pairs of cells within the radius or of neighbouring classes, a table that no data enlarges
    dealt = nodes.join(F.broadcast(partners), ["high", "low"]).withColumn("tile", F.pmod(F.xxhash64("fp", "id"), F.col("own")).cast("int"))
    same = F.col("cell_a") == F.col("cell_b")
    first = F.when(same & (F.col("side") == 0), F.col("tile")).otherwise(0)
    last = F.when(same & (F.col("side") == 1), F.col("tile") - 1).otherwise(F.col("other") - 1)
    dealt = dealt.where(first <= last).withColumn("facing", F.explode(F.sequence(first, last)))
    left = F.col("side") == 0
    dealt = dealt.select(
        "cell_a", "cell_b", F.when(left, F.col("tile")).otherwise(F.col("facing")).alias("tile_a"),
        F.when(left, F.col("facing")).otherwise(F.col("tile")).alias("tile_b"), "side", "id", "fp", "size",
    )

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bits", pa.int32()), ("size_a", pa.int64()), ("size_b", pa.int64())])

    def compare(rows: pa.Table) -> pa.Table:
        side, ids, sizes = (rows[c].to_numpy() for c in ("side", "id", "size"))
        fps = rows["fp"].to_numpy().view(np.uint64)
        one = side == 0
        inside = rows["cell_a"][0].as_py() == rows["cell_b"][0].as_py() and rows["tile_a"][0].as_py() == rows["tile_b"][0].as_py()
        far = one if inside else ~one
        i, j, bits = tile_links(fps[one], None if inside else fps[far], radius, (sizes[one], sizes[far]) if ratio else None, ratio)
        return pa.table([ids[one][i], ids[far][j], bits.astype(np.int32), sizes[one][i], sizes[far][j]], schema=schema)

    return dealt.groupBy("cell_a", "tile_a", "cell_b", "tile_b").applyInArrow(compare, "a long, b long, bits int, size_a long, size_b long")


def fingerprint_groups(docs: DataFrame, shingle_words: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and ``component``: the smallest id reachable over fingerprints that differ in at most ``radius`` bits.

    Equal fingerprints are one node, so copies add no links. Texts without words have fingerprint zero and link like any
    other. One output row for each input row, repeated ids and rows included; a null id has a fingerprint, but the
    component of its non-null equals, if any. Empty tables give no rows; other columns are not read.
    """
    marked = staged(fingerprints(docs, shingle_words, id_col, text_col).select(F.col(id_col).alias("doc_id"), "fp"), "fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("id")).withColumn("size", F.lit(0).cast("long")), "nodes")
    found = components(near_links(nodes, radius).select("a", "b"))
    owned = staged(nodes.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component")), "owned")
    return marked.join(owned, "fp", "left").select("doc_id", "fp", "component")
