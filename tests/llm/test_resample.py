"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from trackflow.llm import resample
from trackflow.llm.q_resample import op12_importance_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10000 for f in features(text)[1]]


def brute(docs, target):
    """(doc_id, n_features, weight, score, rank) of every document."""
    s, t = Counter(b for _, text in docs for b in buckets(text)), Counter(b for text in target for b in buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        own = buckets(text)
        weight = math.floor(sum(gain[b] for b in own) / len(own)) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, features(text)[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    drawn = order[: 25 * len(order) // 100]
    rank = {}
    for k, r in enumerate(drawn, 1):
        rank.setdefault(r, []).append(k)
    return sorted(((r[0], *r[2:], rank[r].pop() if rank.get(r) else None) for r in rows), key=repr)


@pytest.mark.parametrize("sf", [SF])
def test_op12_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted(map(tuple, op12_importance_resampling(spark, sf).collect()), key=repr) == brute(docs, target)


def test_edge_rows(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["Alpha", "beta", "Γάμμα", "d3", "x--y", "Éa"]) for _ in range(n))
    same = text(40)
    docs = [(1, None), (2, ""), (None, text(30)), (None, text(31)), (5, "w " * 19), (5, "w " * 20), *[(7, same)] * 9, (8, text(70_000)), *[(100 + k, text(25)) for k in range(30)]]
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, score int, rank int")
    target = spark.createDataFrame([(None,), ("",), (text(50),)], "text string")
    got = resample.resample(df, target).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, [r.text for r in target.collect()])
    assert resample.resample(df.limit(0), target).count() == 0
    assert {r.rank for r in resample.resample(df.limit(3), target.limit(0)).collect()} == {None}


def test_words_of_all_bytes():
    text = "".join(chr(c) for c in range(0x250)) + " 𝔘 x"
    n, own = resample.feature_buckets(text)
    assert (n, sorted(own.tolist())) == (features(text)[0], sorted(buckets(text)))


@pytest.mark.parametrize("k", [1, 2, 399, 400, 1000, 1001])
def test_quickselect_takes_the_kth_of_tied_keys(spark, k):
    rng = random.Random(k)
    rows = [(rng.randint(-3, 3), rng.randint(0, 40), rng.randint(-2, 0)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "best long, id long, features long")
    key, rounds = resample.kth_key(df, k, seed=1, pivots=3)
    assert key == (sorted(rows)[k - 1] if k <= 1000 else None) and rounds < 40


def test_ranks_are_gapless_over_parts(spark):
    rows = spark.range(500).selectExpr("id % 7 AS best", "id", "0L AS features").repartition(5)
    got = resample.ranked(rows).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501)) and [(r.best, r.id) for r in got] == sorted((i % 7, i) for i in range(500))
