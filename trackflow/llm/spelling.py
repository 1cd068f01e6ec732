"""Groups of spelling variants by finite-state composition.

The vocabulary is an acceptor; composed with a transducer of one edit and with itself, it accepts exactly the pairs of words one
edit apart. The composition is cut into parts by its initial states: a pair whose edit lies behind a common stem meets in the part
of that stem, and of words of six letters or more every pair has a common stem of three from the left or from the
right. A part over ``PART`` words is cut further: into the parts of its longer stems, and the few words whose edit
is the next letter. So a part is bounded whatever stem is common, and each builds and composes a minimal acceptor of its own words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.work import ready, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words of one part of the composition.
PART = 20_000
#: Different words that a task counts before it passes them on.
FLUSH = 400_000
NOISE = 199


def counted_words(key: str, text: str | None, noise: int = NOISE) -> Counter:
    """Occurrences of the words of one text: runs of Latin letters, A-Z in lower case; a null text has none.

    Of a run whose hash with the key is a multiple of ``noise`` (0: of none), the letter that the hash names is missing.
    """
    found = Counter(RUN.findall((text or "").encode("utf-8", "replace").lower().decode()))
    if not noise:
        return found
    crc, start, out = zlib.crc32, zlib.crc32(f"{key}:".encode()), Counter()
    for run, n in found.items():
        h = crc(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, noise: int = NOISE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of at least so many letters and occurrences over all texts.

    Tasks add up before the shuffle, so a frequent word is one row of a task. A null id counts as an empty key.
    """
    ready(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in counted_words(i or "", text, noise).items():
                    if len(word) >= min_chars:
                        seen[word] += n
                if len(seen) >= FLUSH:
                    yield out(seen)
                    seen = Counter()
        yield out(seen)

    each = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """The minimal acyclic acceptor of sorted, different words. State 0 is the first; states are numbers."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path = [0]  # states of the last word, still open
        last = ""

        def close(depth: int) -> None:
            """States of the last word deeper than ``depth`` get no more arcs: each becomes its equal, if there is one."""
            while len(path) > depth + 1:
                state = path.pop()
                form = (self.final[state], *self.arcs[state].items())
                same = known.setdefault(form, state)
                if same != state:
                    self.arcs[path[-1]][last[len(path) - 1]] = same
                    if state == len(self.arcs) - 1:
                        self.arcs.pop()
                        self.final.pop()

        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            close(common)
            last = word
            for letter in word[common:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
        close(0)


class OneEdit:
    """Composition of an acceptor, one edit, and the acceptor: states are one state before the edit, and pairs of states after it."""

    def __init__(self, acceptor: Acceptor) -> None:
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.meet: dict[tuple[int, int], bool] = {}
        self.edits: dict[int, list[tuple[str, str, int, int]]] = {}
        self.fruitful: dict[int, bool] = {}

    def meets(self, one: int, other: int) -> bool:
        """Whether some string leads from both states to an end."""
        meet, stack = self.meet, [(min(one, other), max(one, other))]
        while stack:
            pair = stack[-1]
            if pair in meet:
                stack.pop()
                continue
            p, q = pair
            if p == q or (self.final[p] and self.final[q]):
                meet[pair] = True
                stack.pop()
                continue
            few, many = sorted((self.arcs[p], self.arcs[q]), key=len)
            after = [(min(few[c], many[c]), max(few[c], many[c])) for c in few if c in many]
            if any(meet.get(x) for x in after):
                meet[pair] = True
                stack.pop()
                continue
            unknown = next((x for x in after if x not in meet), None)
            if unknown is None:
                meet[pair] = False
                stack.pop()
            else:
                stack.append(unknown)
        return meet[min(one, other), max(one, other)]

    def edits_at(self, state: int) -> list[tuple[str, str, int, int]]:
        """Edits of the next letter that lead to a pair of words: what either word reads, and the states behind."""
        if state not in self.edits:
            arcs = sorted(self.arcs[state].items())
            found = [(a, b, p, q) for i, (a, p) in enumerate(arcs) for b, q in arcs[:i] if self.meets(p, q)]
            self.edits[state] = found + [(a, "", p, state) for a, p in arcs if self.meets(p, state)]
        return self.edits[state]

    def mark_fruitful(self) -> None:
        """For every state, whether an edit at it or behind it leads to a pair."""
        stack = [0]
        while stack:
            state = stack[-1]
            if state in self.fruitful:
                stack.pop()
                continue
            todo = [q for q in self.arcs[state].values() if q not in self.fruitful]
            if todo:
                stack.extend(todo)
            else:
                self.fruitful[state] = any(self.fruitful[q] for q in self.arcs[state].values()) or bool(self.edits_at(state))
                stack.pop()

    def endings(self, one: int, other: int) -> Iterator[str]:
        """All strings that lead from both states to an end."""
        stack = [(one, other, "")]
        while stack:
            p, q, text = stack.pop()
            if self.final[p] and self.final[q]:
                yield text
            for c in self.arcs[p].keys() & self.arcs[q].keys():
                p2, q2 = self.arcs[p][c], self.arcs[q][c]
                if self.meets(p2, q2):
                    stack.append((p2, q2, text + c))

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Accepted pairs, one way round; a pair with a doubled letter may come twice."""
        self.mark_fruitful()
        stack = [(0, "")]
        while stack:
            state, stem = stack.pop()
            if not self.fruitful[state]:
                continue
            for a, b, p, q in self.edits_at(state):
                for end in self.endings(p, q):
                    yield stem + a + end, stem + b + end
            stack.extend((q, stem + c) for c, q in self.arcs[state].items())


def near_pairs(words: list[str]) -> set[tuple[str, str]]:
    """All pairs of sorted, different words one edit apart, one way round."""
    return set(OneEdit(Acceptor(words)).pairs()) if len(words) > 1 else set()


def parts(words: DataFrame, min_chars: int, part: int = PART) -> DataFrame:
    """Members ``way``, ``stem``, ``rest``, ``own``, ``n`` of the parts of the composition; ``own`` is the word read that way.

    Only whether a part is too large is asked of Spark; its words are dealt out by joins, and no round makes more than three rows of one.
    """
    left = min_chars // 2
    read = F.reverse("word")
    ways = (F.struct(F.lit(0).alias("way"), F.substring("word", 1, left).alias("stem"), F.col("word").alias("own")), F.struct(F.lit(1).alias("way"), F.substring(read, 1, min_chars - left).alias("stem"), read.alias("own")))
    rows = words.select(F.explode(F.array(*ways)).alias("m"), "n").select("m.*", F.lit(None).cast("string").alias("rest"), "n")
    whole = None
    while True:
        large = staged(rows.groupBy("way", "stem").count().where(F.col("count") > part).select("way", "stem"), "large")
        if large.isEmpty():
            return whole.unionByName(rows) if whole is not None else rows
        small = rows.join(large, ["way", "stem"], "left_anti")
        cut = rows.join(large, ["way", "stem"], "left_semi")
        n = F.length("stem")
        longer = cut.where(F.length("own") > n).withColumn("stem", F.expr("substring(own, 1, length(stem) + 1)"))
        rests = F.array(F.when(F.length("own") > n, F.expr("substring(own, length(stem) + 2)")), F.expr("substring(own, length(stem) + 1)"))
        here = cut.withColumn("rest", F.explode(rests)).where(F.col("rest").isNotNull())
        done = small.unionByName(here)
        whole = done if whole is None else whole.unionByName(done)
        rows = staged(longer, "stems")


def one_edit_pairs(words: DataFrame, min_chars: int, part: int = PART) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for every pair of different words one edit apart, both ways round, each once.

    ``words``: word, n; different words of at least ``min_chars`` >= 2 letters, from a stored table.
    """
    ready(words.sparkSession)
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def composed(way: int, group: dict[str, int]) -> pa.RecordBatch:
        turn = (lambda w: w[::-1]) if way else (lambda w: w)
        both = []
        for a, b in near_pairs(list(group)):
            both.append((turn(a), turn(b), group[b]))
            both.append((turn(b), turn(a), group[a]))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in both], f.type) for k, f in enumerate(schema)], schema=schema)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, {}
        for batch in batches:
            for way, stem, rest, own, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (way, stem, rest) != now:
                    if len(group) > 1:
                        yield composed(now[0], group)
                    now, group = (way, stem, rest), {}
                group[own] = n
        if len(group) > 1:
            yield composed(now[0], group)

    key = ["way", "stem", "rest"]
    dealt = parts(words, min_chars, part).select(*key, "own", "n").repartition(*key).sortWithinPartitions(*key, "own")
    return dealt.mapInArrow(fn, "word string, near string, near_n long").dropDuplicates(["word", "near"])


def last_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for the words of ``forms`` (word, form), which has no cycles: forms are followed to their last.

    Each round doubles how far a row sees, so rounds grow with the logarithm of the longest chain.
    """
    seen = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = seen.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(seen.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        seen = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return seen


def variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, noise: int = NOISE, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the vocabulary.

    A word's form is its near word of most occurrences (ties: smallest in code-point order), if those are ``ratio`` > 1 times its own
    or more; its root is where forms lead. Texts that are null, empty or without long words add nothing; repeated ids
    and rows count each; an empty table gives no rows; other columns are not read.
    """
    words = staged(vocabulary(docs, min_chars, min_count, noise, id_col, text_col), "vocabulary")
    pairs = one_edit_pairs(words, min_chars, part)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("most", -F.col("best.less"))
    taken = F.col("most") >= ratio * F.col("n")
    found = staged(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, F.col("most")).alias("form_n")), "variants")
    roots = last_forms(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
