"""Near duplicates by MinHash against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from trackflow.llm import minhash
from trackflow.llm.q_minhash import op13_minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(docs, k=4):
    """doc_id -> (size, smallest reachable id), all pairs that share a shingle compared in full."""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    up = {i: i for i in docs}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i in sorted(docs):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in docs}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_op13_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_minhash(spark, sf).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def families(rng, n, words, edits):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = [*base]
        for at in rng.sample(range(words), rng.randint(*edits)):
            own[at] = f"x{rng.randint(0, 10**9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("few", "tile_rows"), [(16, 1024), (1, 7), (1000, 1024)])
def test_families_around_the_threshold(spark, monkeypatch, few, tile_rows):
    """Members of a family are alike to some of it only; parts of any size give the same components."""
    whole = minhash.open_links
    monkeypatch.setattr(minhash, "open_links", lambda *a: whole(*a, few=few, tile_rows=tile_rows))
    monkeypatch.setattr(minhash, "SPLIT", 10)
    rng = random.Random(few)
    texts = [t for k in range(8) for t in families(rng, 40, 60 + 20 * k, (0, 3 + k))]
    docs = dict(enumerate(rng.sample(texts, len(texts))))
    got = minhash.minhash_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), 4).collect()
    want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component) for r in got} == want and 10 < len({c for _, c in want.values()}) < len(docs) - 50


def test_edge_rows(spark):
    rng = random.Random(6)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    one, long = words(100), words(50_000)
    near, long_near = [*one], [*long]
    near[50], long_near[7] = "changed", "changed"
    rows = [(1, None), (2, ""), (3, " \n"), (4, " ".join(one)), (5, "\t".join(near).upper()), (6, " ".join(one)), (6, " ".join(one)), (7, "two words"), (8, "TWO  words"), (9, "words two"), (10, " ".join(long)), (11, " ".join(long_near)), (4, "another text under the same id"), (12, "another text under the same id"), (None, " ".join(near)), (None, "alone")]
    df = spark.createDataFrame([(*r, 5, b"x") for r in rows], "doc_id long, text string, node int, hash binary")
    got = sorted(((r.doc_id, r.n_shingles, r.component) for r in minhash.minhash_groups(df, 4).collect()), key=repr)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 97, 4), (4, 3, 4), (5, 97, 4), (6, 97, 4), (6, 97, 4), (7, 1, 7), (8, 1, 7), (9, 1, 9), (10, 49_997, 10), (11, 49_997, 10), (12, 3, 4), (None, 97, 4), (None, 1, None)]
    assert got == sorted(want, key=repr)
    assert minhash.minhash_groups(df.limit(0)).count() == 0


def test_no_pair_within_reach_is_lost():
    rng = np.random.default_rng(1)
    for _ in range(300):
        one = rng.integers(0, 1 << 16, minhash.SLOTS).astype(np.uint16)
        other = one.copy()
        other[rng.choice(minhash.SLOTS, minhash.REACH, replace=False)] ^= 1
        a, b = minhash.chunk_keys(np.stack([one, other]))
        assert set(a.tolist()) & set(b.tolist()) and len(set(a.tolist())) == len(a)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    far = []
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 64, 360, dtype=np.uint64))
        one, other = (np.frombuffer(minhash.signature(np.sort(s)), "<u2") for s in (x[:320], x[40:]))
        far.append((one != other).mean())
    assert abs(np.mean(far) - 2 / 9) < 0.02 and max(far) * minhash.SLOTS <= minhash.REACH
