"""Importance resampling of documents towards a target text collection.

Features are runs of one and two words, hashed into buckets. Buckets of both collections are counted exactly; the gain of a
bucket says how much more often the target has it. A document's weight is its mean gain, read from an array of gains, and a
hash of its id gives a Gumbel draw, so the highest scores are a weighted draw without replacement. The share to draw is found by a
distributed quickselect: random keys are pivots, every row is counted as below, at or between them, and the range narrows
until a pivot is the k-th key. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.work import map_rows, ready, staged

BUCKETS = 10_000
#: Pivots of one round: it leaves about one in so many of the open keys.
PIVOTS = 32
#: Bytes that part words: all of ASCII but digits and letters. Letters A-Z become lower-case.
_PARTS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """How many words a whole text has, and the bucket of each of its runs of one and of two words; a null text has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_PARTS).split()
    crc = zlib.crc32
    ones = [crc(w) for w in words]
    twos = [crc(w, crc(b" ", one)) for w, one in zip(words[1:], ones)]
    return len(words), (np.array(ones + twos, dtype=np.uint32) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts: one row for each task and bucket is summed in Spark, ``buckets`` rows reach the driver."""
    ready(texts.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += np.bincount(feature_buckets(text, buckets)[1], minlength=buckets)
        own = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(seen[own])], schema=schema)

    found = texts.select(text_col).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in target and source, each count raised by one."""
    size, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s_all + size)) / ((source + 1.0) * (t_all + size))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], dtype=np.int64)


def gumbel(key: str, seed: int) -> int:
    """Thousandths of a Gumbel draw, from the first 32 bits of a hash of seed and key."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row; the array of gains goes to every task."""
    buckets = len(gains)

    def fn(ids: list, texts: list) -> list:
        rows = []
        for i, text in zip(ids, texts, strict=True):
            n_words, own = feature_buckets(text, buckets)
            weight = int(gains[own].sum()) // len(own) if len(own) else 0
            rows.append((i, n_words, len(own), weight, weight + gumbel("" if i is None else str(i), seed)))
        return list(map(list, zip(*rows, strict=True))) if rows else [[]] * 5

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col), fn, "doc_id long, n_words long, n_features long, weight long, score long")


#: Best first: highest score, then smallest id (a missing id last), then most features. Rows equal in all are alike in all columns.
KEY = ("best", "id", "features")


def with_key(rows: DataFrame) -> DataFrame:
    """The composite key of which small is good, as three longs; no pair of different results shares one."""
    last = F.lit((1 << 63) - 1)
    return rows.withColumns({"best": -F.col("score"), "id": F.coalesce("doc_id", last), "features": -F.col("n_features")})


def _key() -> Column:
    return F.struct(*KEY)


def _value(key: tuple[int, ...]) -> Column:
    return F.struct(*(F.lit(x).cast("long").alias(c) for x, c in zip(key, KEY, strict=True)))


def kth_key(rows: DataFrame, k: int, seed: int, pivots: int = PIVOTS) -> tuple[tuple[int, ...] | None, int]:
    """The k-th smallest key of a stored table (k from 1), and how many rounds found it.

    A round takes random keys of the open range as pivots (those of the smallest hashes, so a repeated task takes the same) and
    counts every open row exactly: at a pivot, or between two. At most 2 * pivots + 1 counts reach the driver.
    """
    low = high = None
    rounds = 0
    while True:
        rounds += 1
        open_ = rows
        if low is not None:
            open_ = open_.where(_key() > _value(low))
        if high is not None:
            open_ = open_.where(_key() < _value(high))
        draw = F.xxhash64(F.lit(seed + rounds), *KEY)
        chosen = sorted({tuple(r) for r in open_.orderBy(draw).select(*KEY).limit(pivots).collect()})
        if not chosen:
            return None, rounds
        # slot 2i: below pivot i; slot 2i + 1: at pivot i
        slot = F.lit(2 * len(chosen))
        for i in reversed(range(len(chosen))):
            slot = F.when(_key() < _value(chosen[i]), 2 * i).when(_key() == _value(chosen[i]), 2 * i + 1).otherwise(slot)
        counts = {r.slot: r["count"] for r in open_.select(slot.alias("slot")).groupBy("slot").count().collect()}
        at = None
        for s in sorted(counts):
            if k <= counts[s]:
                at = s
                break
            k -= counts[s]
        if at is None:
            return None, rounds
        if at % 2:
            return chosen[at // 2], rounds
        low = chosen[at // 2 - 1] if at else low
        high = chosen[at // 2] if at // 2 < len(chosen) else high


def ranked(winners: DataFrame) -> DataFrame:
    """``rank`` from 1 in the order of the key: a range partitioning, sorted parts, and the rows in the parts before.

    Only one count for each part reaches the driver.
    """
    spark = winners.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = winners.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).withColumn("place", F.monotonically_increasing_id())
    placed = staged(placed, "winners")  # a place is the part's number above 33 bits, and the row's number in the part
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy(F.shiftright("place", 33).alias("part")).count().collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "part long, before long")
    own = placed.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offsets), "part")  # at most one row for each part
    return own.withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("part", "before", "place")


def resample(docs: DataFrame, target: DataFrame, share: int = 25, min_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and, if drawn, its ``rank``.

    Of the documents with at least ``min_words`` words, ``share`` per cent (rounded down) of the highest scores are drawn, ties to
    smaller ids. Ids are integers; a null id draws by the hash of an empty one and loses ties. A null or empty text has weight 0 and
    is not drawn. Repeated ids and rows each count and are each returned; of rows alike in all columns, as many
    are drawn as fit. Empty tables give no rows; an empty target counts as zero in every bucket. Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = staged(with_key(scored(docs, gains, seed, id_col, text_col)), "scored")
    able = rows.where(F.col("n_words") >= min_words)
    k = share * able.count() // 100
    kth = kth_key(able, k, seed)[0] if k else None
    out = ("doc_id", "n_words", "n_features", "weight", "score")
    if kth is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    first = (F.col("n_words") >= min_words) & (_key() <= _value(kth))
    drawn = ranked(rows.where(first)).select(*out, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return drawn.unionByName(rows.where(~first).select(*out, F.lit(None).cast("long").alias("rank")))
