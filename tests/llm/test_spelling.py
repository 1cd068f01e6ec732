"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from trackflow.llm import spelling
from trackflow.llm.q_spelling import op11_spelling_variants

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(u, v):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_words(docs):
    seen = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def brute(docs):
    n = brute_words(docs)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def rows_of(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("sf", [SF])
def test_op11_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert rows_of(op11_spelling_variants(spark, sf)) == want and any(r[1] for r in want)


@pytest.mark.parametrize("part", [1, 2, 7, 20_000])
def test_parts_of_any_size_lose_no_pair(spark, part):
    rng = random.Random(part)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(160)} | {"aaaaaa", "aaaaaaa"})
    want = {(u, v, words.index(v)) for u in words for v in words if u != v and abs(len(u) - len(v)) < 2 and one_edit(u, v)}
    df = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n long")
    got = [tuple(r) for r in spelling.one_edit_pairs(df, 4, part).collect()]
    assert set(got) == want and len(got) == len(want)


def test_the_acceptor_is_minimal_and_composed():
    rng = random.Random(4)
    for _ in range(30):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(40)})
        got = spelling.near_pairs(words)
        assert {frozenset(p) for p in got} == {frozenset((u, v)) for u in words for v in words if u < v and one_edit(u, v)}
        a = spelling.Acceptor(words)
        ends = {}  # right language of every state that can be reached

        def language(q):
            if q not in ends:
                ends[q] = frozenset([""] if a.final[q] else []) | {c + x for c, p in a.arcs[q].items() for x in language(p)}
            return ends[q]

        assert language(0) == frozenset(words) and len(set(ends.values())) == len(ends)
    long = "x" * 30_000
    assert {frozenset(p) for p in spelling.near_pairs(sorted([long, long + "y", long[:-1] + "z"]))} == {frozenset((long, long + "y")), frozenset((long, long[:-1] + "z"))}


def test_edge_rows(spark):
    long = "b" * 40_000
    docs = [(1, None), (2, ""), (None, "Straße straße Straßen " * 9), (4, "Ünder ünder÷x " * 5 + "ÜNDERX"), (5, f"{long} " * 6), (5, f"{long} " * 6), (6, f"{long}c " * 70), (7, "kitten " * 5 + "kittten " * 30 + "kitttten " * 200 + "kitten1kitten"), (8, "a b c")]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, word string")
    assert rows_of(spelling.variants(df)) == brute(docs)
    assert spelling.variants(df.limit(0)).count() == 0
    chain = spark.createDataFrame([(f"w{k:02}", f"w{k + 1:02}") for k in range(20)], "word string, form string")
    assert {r.root for r in spelling.last_forms(chain).collect()} == {"w20"}
