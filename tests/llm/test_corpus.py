"""Near duplicates, long repeats, neighbours and the pipeline against brute force and planted cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from trackflow.llm import minhash, near_texts, neighbours, repeats, simhash
from trackflow.llm.graph import components
from trackflow.llm.q_near import op1_simhash
from trackflow.llm.q_repeats import op3_suffix_array_dedup
from trackflow.llm.q_vectors import op2_nearest_neighbours

SF = "/root/testdata/sf0.001"


def smallest_reachable(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 116)] + [(200, k) for k in range(201, 230)] + [(5, 5), (None, 3)]
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = smallest_reachable({x for p in real for x in p}, real)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text, k):
    words = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op1_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: brute_fingerprint(t, 4) for d, t in docs.items()}
    links = [(a, b) for a in docs for b in docs if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4]
    want = smallest_reachable(docs, links)
    got = op1_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (format(prints[d], "016x"), want[d]) for d in docs}


@pytest.mark.parametrize("tile", [3, 1000])
def test_tiles_lose_no_component(spark, tile):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = [int(base[i % 12]) for i in range(200)]
    for i in range(200):
        for bit in rng.choice(63, rng.integers(0, 5), replace=False):
            fps[i] ^= 1 << int(bit)
    nodes = spark.createDataFrame([(i, f, 1) for i, f in enumerate(fps)], "id long, fp long, size long")
    got = simhash.near_links(nodes, 4, tile=tile).collect()
    links = [(a, b) for a in range(200) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    assert smallest_reachable(range(200), [(r.a, r.b) for r in got]) == smallest_reachable(range(200), links)
    assert all(bin(fps[r.a] ^ fps[r.b]).count("1") == r.bits <= 4 for r in got)


def test_strips_are_skipped_only_beyond_the_radius(monkeypatch):
    monkeypatch.setattr(simhash, "STRIP", 7)
    rng = np.random.default_rng(2)
    left = rng.integers(0, 1 << 63, 90, dtype=np.uint64) & np.uint64(0xFF0F)
    i, j, bits = simhash.tile_links(left, None, 3)
    links = [(a, b) for a in range(90) for b in range(a) if int(left[a] ^ left[b]).bit_count() <= 3]
    assert smallest_reachable(range(90), list(zip(i.tolist(), j.tolist()))) == smallest_reachable(range(90), links)


@pytest.mark.parametrize("tile", [3, 1000])
def test_links_of_like_sizes_lose_no_component(spark, tile):
    """Sizes at the very ratio count; links of a text in between, nearer by bits but of another size, do not stand for others."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = [int(base[i % 12]) for i in range(200)]
    for i in range(200):
        for bit in rng.choice(63, rng.integers(0, 4), replace=False):
            fps[i] ^= 1 << int(bit)
    sizes = [int(x) for x in rng.choice([0, 1, 4, 5, 8, 10, 15, 16, 20, 25, 99, 100, 125], 200)]
    nodes = spark.createDataFrame([*((i, f, s) for i, (f, s) in enumerate(zip(fps, sizes))), (500, 1, None), (501, None, 1)], "id long, fp long, size long")
    got = simhash.near_links(nodes, 4, tile=tile, ratio=0.8).collect()
    able = lambda a, b: 5 * min(sizes[a], sizes[b]) >= 4 * max(sizes[a], sizes[b]) and (fps[a] ^ fps[b]).bit_count() <= 4
    want = smallest_reachable(range(200), [(a, b) for a in range(200) for b in range(a) if able(a, b)])
    assert smallest_reachable(range(200), [(r.a, r.b) for r in got]) == want and all(able(r.a, r.b) for r in got)
    assert len(set(want.values())) > 40
    assert simhash.near_links(nodes.limit(0), 4, ratio=0.8).count() == 0


def test_texts_of_unlike_sizes_are_not_compared(monkeypatch):
    """Ten sizes, each far from the next: only rows of one size meet."""
    monkeypatch.setattr(simhash, "STRIP", 100)
    met = []
    compare = simhash.within
    monkeypatch.setattr(simhash, "within", lambda a, b, radius: met.append(len(a) * len(b)) or compare(a, b, radius))
    fps = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.uint64)
    sizes = np.tile(2 ** np.arange(4, 14), 300)
    simhash.tile_links(fps, None, 12, (sizes, sizes), 0.8)
    assert 10 * 300 * 299 // 2 <= sum(met) <= 10 * 300 * 300


def test_near_duplicates_edge_rows(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    one, other = words(300), words(300)
    near = [*one]
    near[150] = "changed"
    rows = [(1, None, 0), (2, "", 0), (3, " ".join(one), 0), (4, " ".join(near), 0), (5, " ".join(one), 0), (5, " ".join(one), 0), (6, " ".join(other), 0), (None, " ".join(one), 0), (7, " ".join(words(60_000)), 0), (8, "Two words", 0), (9, "two WORDS", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = {r.doc_id: r.component for r in near_texts.near_groups(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 8, 9: 8}
    marked = simhash.fingerprint_groups(df, 4, 4)
    assert marked.count() == len(rows) and {r.component for r in marked.where("doc_id IS NULL").collect()} == {3}
    assert near_texts.near_groups(df.limit(0)).count() == simhash.fingerprint_groups(df.limit(0), 4, 4).count() == 0


def brute_near(texts, words=5, similarity=0.8):
    """The smallest reachable id over all pairs of texts alike by Jaccard."""
    sets = {i: set(simhash.shingle_hashes(t, words).tolist()) for i, t in texts.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    return smallest_reachable(texts, [(a, b) for a in texts for b in texts if a < b and alike(a, b)])


def family(rng, base, members, edits):
    """Copies of one template, each with so many edits of single words."""
    out = []
    for _ in range(members):
        own = [*base]
        for at in rng.sample(range(len(base)), rng.randint(*edits)):
            own[at] = f"x{rng.randint(0, 10**9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("few", "tile"), [(16, 2048), (1, 5)])
def test_near_groups_of_templates_against_brute_force(spark, monkeypatch, few, tile):
    """Many pairs of a family just miss the likeness, so links that stand for others fail."""
    whole = minhash.open_links
    monkeypatch.setattr(minhash, "open_links", lambda *a: whole(*a, few=few, tile_rows=tile))
    rng = random.Random(3)
    texts = ["", " ", "a", "A b"]
    for size in (60, 150, 250, 400):
        for k in range(3):
            base = [f"w{rng.randint(0, 10**9)}" for _ in range(size)]
            texts += family(rng, base, 20, (size // 100, size // (90 - 15 * k) + 1))
    texts = dict(enumerate(texts))
    got = near_texts.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    want = brute_near(texts)
    assert {r.doc_id: r.component for r in got} == want and {r.doc_id for r in got if r.kept} == set(want.values())
    assert 3 + 2 * 12 < len(set(want.values())) < len(texts) / 2  # some stay apart, some do not


def test_a_key_of_many_texts_apart(spark):
    """Hundreds of different texts share their keys but not their words: they meet in tiles and stay apart, their near copies join."""
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    apart = family(rng, base, 120, (13, 16))
    near = [" ".join([*t.split(" ")[:-1], "end"]) for t in apart[::4]]
    texts = dict(enumerate(apart + near))
    got = {r.doc_id: r.component for r in near_texts.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_near(texts) and 60 < len(set(got.values())) <= 120


def test_different_texts_of_one_id_are_nodes_of_their_own(spark):
    rng = random.Random(4)
    one, other, third = ([f"w{rng.randint(0, 10**6)}" for _ in range(200)] for _ in range(3))
    near = lambda words: " ".join([*words[:199], "end"])
    rows = [(5, " ".join(one)), (5, " ".join(other)), (6, near(one)), (7, near(other)), (8, " ".join(third)), (8, near(third)), (8, near(third))]
    got = near_texts.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component) for r in got) == [(5, 5), (5, 5), (6, 5), (7, 5), (8, 8), (8, 8), (8, 8)]
    stay = {(r.doc_id, r.text_hash) for r in got if r.kept}
    assert sorted(d for d, _ in stay) == [5, 5, 8]
    assert {h for d, h in stay if d == 5} == {hashlib.sha256(t.encode()).hexdigest() for _, t in rows[:2]}


def brute_removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        out.append((len(t), int(covered.sum()), len(repeats.spans_of(covered)), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~covered])).hexdigest()))
    return out


def test_op3_against_brute_force(spark):
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op3_suffix_array_dedup(spark, SF).orderBy("doc_id").collect()]
    assert got == brute_removed([t for _, t in docs], 400)


@pytest.mark.parametrize("seed", range(60))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    parts, group = [], []
    for _ in range(rng.randint(1, 7)):
        x = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40)))
        if parts and rng.random() < 0.6:
            y = rng.choice(parts)
            x = x[: rng.randint(0, len(x))] + y[rng.randint(0, len(y) - 1) :]
        if x not in parts:
            parts.append(x)
            group.append(rng.randint(0, 1))
    number = {g: i for i, g in enumerate(dict.fromkeys(group))}
    group, length = [number[g] for g in group], rng.randint(2, 9)
    got = repeats.marked(parts, group, [False] * len(parts), length)
    for g in set(group):
        own = [p for p, h in zip(parts, group) if h == g]
        want = brute_removed(own, length)
        spans = [s for s, h in zip(got, group) if h == g]
        assert [(sum(b - a for a, b in s), len(s)) for s in spans] == [w[1:3] for w in want]


def repetitive(rng):
    passage, base = rng.randbytes(120), rng.randbytes(500)
    texts = [rng.randbytes(rng.randint(0, 90)) + passage[rng.randint(0, 40) :] + rng.randbytes(rng.randint(0, 90)) for _ in range(25)]
    for _ in range(15):
        t = bytearray(base)
        t[rng.randrange(len(t))] = 0
        texts.append(bytes(t))
    return [*texts, base, base, b"a" * 700, b"ab" * 90, b"", b"x" * 39, b"y" * 40]


@pytest.mark.parametrize("group_bytes", [1 << 20, 300])
def test_repeats_in_small_and_large_groups(spark, monkeypatch, group_bytes):
    """Groups beyond the bound of a task give the same spans by the other way."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    texts = [bytes(b % 96 + 32 for b in t) for t in repetitive(random.Random(3))]
    df = spark.createDataFrame([(i, t.decode(), "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = repeats.kept(repeats.repeated_spans(df, 40)).orderBy("doc_id").collect()
    assert [(len(r.bytes), len(r.bytes) - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got] == brute_removed(texts, 40)


def test_a_large_group_with_few_repeats(spark, monkeypatch):
    """Texts that share a phrase but no window: few windows are hashed, and the repeats among them are found."""
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    phrase, passage = noise(70), noise(220)
    texts = [noise(rng.randint(100, 300)) + phrase + noise(rng.randint(100, 300)) for _ in range(80)]
    texts += [noise(rng.randint(0, 50)) + passage[:100] + phrase + passage[100:] + noise(rng.randint(0, 50)) for _ in range(3)]
    texts += [f"{phrase}{texts[0][-80:]}" * 3, phrase * 8]
    monkeypatch.setattr(repeats, "GROUP_BYTES", 300)
    hashed = {}
    whole = repeats.staged

    def counted(df, name, *more):
        out = whole(df, name, *more)
        hashed[name] = hashed.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(repeats, "staged", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.kept(repeats.repeated_spans(df, 200)).orderBy("doc_id").collect()
    assert [(len(r.bytes), len(r.bytes) - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got] == brute_removed([t.encode() for t in texts], 200)
    assert sum(bool(r.spans) for r in got) == 5 and hashed["windows"] < 80 * 100


def test_repeats_edge_rows(spark):
    long = " ".join(str(i) for i in range(20_000))
    df = spark.createDataFrame([(1, None), (2, ""), (None, "z" * 30 + "q"), (3, long), (3, long), (4, "é" * 30), (5, "aé" + "é" * 30)], "doc_id long, text string")
    got = {(r.doc_id, len(r.bytes)): [(s.start, s.end) for s in r.spans] for r in repeats.repeated_spans(df, 50).collect()}
    assert got[1, 0] == got[2, 0] == got[None, 31] == [] and got[3, len(long)] == [(0, len(long))]
    assert got[4, 60] == [(0, 60)] and got[5, 63] == [(1, 63)]
    assert repeats.repeated_spans(df.limit(0), 50).count() == 0


def test_op2_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], dtype=np.float64)
    got = {}
    for r in op2_nearest_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        away = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1))
        away[ids == q] = np.inf
        assert sorted(found) == list(range(1, 11))
        assert [(s, i) for i, s in (found[k] for k in range(1, 11))] == sorted((s, i) for i, s in found.values())
        assert all(abs(away[ids == i][0] - s) < 1e-12 for i, s in found.values())
        hits += len({i for i, _ in found.values()} & set(ids[np.lexsort((ids, away))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_edge_rows(spark):
    """Copies of one vector beyond any list, ties, unusable vectors, few candidates; blocks of a few rows change nothing."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 80)] + [(100 + i, [0.0, 1.0, float(i)]) for i in range(4)]
    rows += [(200, None), (201, [0.0, 0.0, 0.0]), (202, [nan, 1.0, 1.0]), (203, [inf, 1.0, 1.0]), (204, [1.0, None, 1.0]), (205, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (3, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = neighbours.nearest(df, df.where("vec_id IN (0, 50, 100, 200, 201, 202, 205)"), k=5, block=7)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert found[0] == [(i, 0.0) for i in (1, 2, 3, 4, 5)] and found[50] == [(i, 0.0) for i in (0, 1, 2, 3, 4)]
    assert set(found) == {0, 50, 100} and found[100][:2] == [(101, 1.0), (0, round(2**0.5, 9))]
    few = df.where("vec_id >= 100")
    assert [r.vec_id for r in neighbours.nearest(few, few.where("vec_id = 101")).orderBy("rank").collect()] == [100, 102, 103]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_chi_square():
    for m, x in ((2, 5.991464547), (8, 15.50731306)):
        assert abs(neighbours.chi_square_quantile(0.95, m) - x) < 1e-6


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) + rng.choice([""] * 6 + [",", "."]) for _ in range(n))


def test_pipeline_on_planted_documents(spark):
    rng = random.Random(11)
    clean = {i: prose(rng, rng.randint(40, 300)) for i in range(30)}
    texts = dict(clean)
    texts[100] = clean[0]
    words = clean[1].split(" ")
    words[len(words) // 2] = "other"
    texts[101] = " ".join(words)
    texts[102], texts[103], texts[104] = None, "", "few words"
    texts[105] = "BUY!! NOW!! CHEAP!! PILLS!! HERE!! TODAY!! ONLY!! FOR!! YOU!! AND!! ALL!!"
    passage = prose(rng, 55)
    for i in (2, 3, 4):
        texts[i] = f"{clean[i]}\n{passage}\n{prose(rng, 30)}"
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tile string")
    names = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), name)
        results.append({r.doc_id: r.asDict() for r in docs.collect()} if "text" in docs.columns else docs.collect())
        if "text" in docs.columns:
            assert docs.columns == names and all(r["n_chars"] == len(r["text"]) and r["tile"] == "extra" for r in results[-1].values())
    rules, near, cut, pieces = results
    assert set(rules) == set(texts) - {102, 103, 104, 105}
    assert set(near) == set(clean)
    assert set(cut) == set(clean) and not any(passage[50:250] in r["text"] for r in cut.values())
    assert all(cut[i]["text"] == clean[i] for i in clean if i not in (2, 3, 4))
    assert {p.doc_id for p in pieces} == set(clean) and all(p.sequence_id is not None for p in pieces)


def test_pipeline_edge_tables(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(None, prose(random.Random(1), 40), None, None, None)] * 2 + [(1, None, None, None, None)], empty.schema)
    for docs, n in ((empty, 0), (odd, 2)):
        for name, stage in corpus_pipeline.STAGES[:2]:
            docs = corpus_pipeline.staged(stage(spark, docs, SF), name)
        assert docs.count() == n
        for name, stage in corpus_pipeline.STAGES[2:]:
            docs = corpus_pipeline.staged(stage(spark, docs, SF), name)
        assert docs.count() == 0  # two rows of one text without an id are repeats of each other
