"""Long repeated byte strings, marked by a run-length index over segments that may hold them.

Every window of ``length`` bytes contains the anchor of its text: a local minimum among hashes of short strings. Equal
windows have equal anchors, so a repeat can only lie in segments around anchors that occur at least twice. Segments with one
anchor meet in one group; identical ones are entered once, with their multiplicity. For the groups of a batch, a
Burrows-Wheeler transform is built over one alphabet per group and compressed to runs. Only run ends are sampled: each with
its text position and the length of the match with its neighbour there. Streaming through the text, a match shortens by one
byte at each step until a sampled end offers a longer one, which gives the matching statistics of every position; those of
at least ``length`` are marked. Groups too large for one task are settled exactly by counting the hashes of their windows,
of those whose neighbourhood occurs again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.work import drop_staged, ready, staged

#: Multiplier of the rolling hash, odd, so that it can be undone modulo 2**64.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Most bytes of a group's distinct segments, and of a batch of groups, that one index covers.
GROUP_BYTES = 2 << 20
BATCH_BYTES = 1 << 20
#: Neighbouring windows of a large group that are counted as one at first.
BLOCK = 16
#: Pairs of suffixes compared at once; their bytes are gathered in arrays of 32 numbers a pair.
PAIR_BLOCK = 1 << 14

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for b in (BASE, pow(BASE, -1, 1 << 64)):
                x = np.full(size, b, dtype=np.uint64)
                x[0] = 1
                _powers.append(np.multiply.accumulate(x))
        del _powers[:-2]
    return _powers[0][:n], _powers[1][:n]


def string_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed hash of the k bytes that begin at each position."""
    n = len(data) - k + 1
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
        h = (total[k:] - total[:-k]) * down[:n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def sliding(x: np.ndarray, w: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every w neighbours, from two running passes over blocks of w."""
    n = len(x)
    fill = np.uint64(MASK) if best is np.minimum else np.uint64(0)
    padded = np.full(-(-n // w) * w, fill, dtype=np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of strings of k bytes that are smallest in some window of ``length`` bytes."""
    h = string_hashes(data, k)
    w = length - k + 1
    least = sliding(h, w, np.minimum)
    edge = np.zeros(w - 1, dtype=np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), w, np.maximum)
    at = np.flatnonzero(most == h)
    return at, h[at]


def segments(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, start, end) of all that windows with the anchor can cover; overlapping ones of one anchor are joined.

    The fourth array says which were joined: those may repeat themselves.
    """
    if len(data) < length:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    at, h = anchors(data, length, k)
    order = np.lexsort((at, h))
    at, h = at[order], h[order]
    start, end = np.maximum(at - (length - k), 0), np.minimum(at + length, len(data))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (start[1:] > end[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return h[new], start[new], end[last], last > np.flatnonzero(new)


def suffix_order(text: np.ndarray, stop: np.ndarray, reach: int) -> np.ndarray:
    """Positions of a text of symbols (group * 256 + byte) in the order of their suffixes, each suffix ending at its ``stop``.

    The first keys hold a group and several bytes; then ranks of prefixes are doubled until they cover ``reach`` symbols, which
    no suffix exceeds. Only positions that share their rank are sorted again.
    """
    n = len(text)
    at = np.arange(n)
    key, h, room = text >> 8, 0, (1 << 62) // (int(text[-1] >> 8) + 2)
    while room >= 257:
        inside = at + h < stop
        key = key * 257 + np.where(inside, (text[np.minimum(at + h, n - 1)] & 255) + 1, 0)
        room //= 257
        h += 1
    order = np.argsort(key)
    slots, rank = at, np.empty(n, dtype=np.int64)
    ranked = key[order]
    while True:
        new = np.ones(len(slots), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        own = order[slots]
        rank[own] = slots[first] + 1
        alone = new & np.append(new[1:], True)
        slots, own = slots[~alone], own[~alone]
        if h >= reach or not len(slots):
            return order
        following = np.where(own + h < stop[own], rank[np.minimum(own + h, n - 1)], 0)
        key = rank[own] * (n + 2) + following
        by = np.argsort(key)
        ranked = key[by]
        order[slots] = own[by]
        h *= 2


def common(text: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the match between the suffixes at a and at b, for a block of pairs at a time."""
    found = np.zeros(len(a), dtype=np.int64)
    for first in range(0, len(a), PAIR_BLOCK):
        some = slice(first, first + PAIR_BLOCK)
        found[some] = common_of(text, stop, a[some], b[some])
    return found


def common_of(text: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    room = np.minimum(stop[a] - a, stop[b] - b)
    found = np.zeros(len(a), dtype=np.int64)
    open_ = np.arange(len(a))
    step = 32
    ahead = np.arange(step)
    n = len(text)
    while len(open_):
        p, q = a[open_] + found[open_], b[open_] + found[open_]
        equal = text[np.minimum(p[:, None] + ahead, n - 1)] == text[np.minimum(q[:, None] + ahead, n - 1)]
        equal &= ahead < (room[open_] - found[open_])[:, None]
        more = np.where(equal.all(axis=1), step, np.argmin(equal, axis=1))
        found[open_] += more
        open_ = open_[more == step]
    return found


def matching_statistics(text: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For every position, how long a match its suffix has anywhere else in the text, from the ends of the runs."""
    n = len(text)
    order = suffix_order(text, stop, int((stop - np.arange(n)).max()))
    first = np.ones(n, dtype=bool)
    first[1:] = stop[1:] != stop[:-1]
    before = np.where(first[order], -1, text[order - 1])  # the transform; segments have no symbol before them
    border = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] < 0))  # between order[i] and order[i + 1] a run ends
    upper, lower = order[border], order[border + 1]
    match = common(text, stop, upper, lower)
    reach = np.full(n, -1, dtype=np.int64)  # end of the longest sampled match that begins here
    np.maximum.at(reach, upper, upper + match)
    np.maximum.at(reach, lower, lower + match)
    at = np.arange(n)
    begin = np.maximum.accumulate(np.where(first, at, 0))
    for_text = np.maximum.accumulate(np.where(first, np.maximum(reach, at), reach))  # a segment's start forgets the one before
    return np.where(for_text > begin, np.minimum(for_text, stop) - at, 0).clip(0)


def marked(parts: list[bytes], group: list[int], several: list[bool], length: int) -> list[list[tuple[int, int]]]:
    """Spans of each segment that lie in strings of ``length`` bytes which its group has at another place too.

    ``several``: the segment itself occurs more than once, so that all of it is a repeat.
    """
    out: list[list[tuple[int, int]]] = [[(0, len(p))] if s else [] for p, s in zip(parts, several, strict=True)]
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(parts), dtype=np.uint8) + 256 * np.repeat(np.array(group), sizes)
    long = matching_statistics(text, np.repeat(ends, sizes)) >= length
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    at = np.flatnonzero(long)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    covered = np.cumsum(edge[:-1]) > 0
    for i, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
        if not several[i]:
            out[i] = spans_of(covered[a:b])
    return out


def spans_of(covered: np.ndarray) -> list[tuple[int, int]]:
    step = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))


SPANS = "array<struct<start: int, end: int>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def as_structs(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], SPAN_TYPE)


def repeated_spans(docs: DataFrame, length: int, anchor: int | None = None, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``bytes`` of the text, ``row`` (a struct of the columns in ``carry``, if any) and ``spans``: the maximal runs of bytes inside strings of ``length`` bytes that
    start at another place too, in the same document or another one. Matches never cross documents.

    One output row for each input row: rows of equal text, repeated ids included, are all repeats of each other. A null text is
    empty; texts shorter than ``length`` have no spans; a null id is kept. Other columns are not read. An empty table gives no rows.
    """
    ready(docs.sparkSession)
    k = anchor or max(length // 8, 8)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"), *([F.struct(*carry).alias("row")] if carry else []))
    source = source.withColumn("hash", F.substring(F.unhex(F.sha2("bytes", 256)), 1, 16))
    n_bytes = F.octet_length("bytes")
    counted = staged(source.where(n_bytes >= length).groupBy("hash").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.min(n_bytes).alias("n")), "copies")

    found = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("hash", pa.binary()), ("start", pa.int32()), ("end", pa.int32()), ("joined", pa.int32())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments of the texts of a task, of equal ones once."""
        seen: set[bytes] = set()
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                h, start, end, joined = segments(np.frombuffer(data, dtype=np.uint8), length, k)
                at = list(zip(start.tolist(), end.tolist(), strict=True))
                columns[0].append(h.view(np.int64))
                columns[1].append(np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in at], dtype=np.uint64).view(np.int64))
                columns[2] += [key] * len(h)
                columns[3].append(start)
                columns[4].append(end)
                columns[5].append(joined)
            flat = [pa.array(c if i == 2 else np.concatenate([np.zeros(0, dtype=np.int64), *c]), f.type) for i, (c, f) in enumerate(zip(columns, found, strict=True))]
            yield pa.RecordBatch.from_arrays(flat, schema=found)

    texts = source.where(n_bytes >= length).select("hash", "bytes")
    places = staged(texts.mapInArrow(cut, "anchor long, segment long, hash binary, start int, end int, joined int"), "places")

    distinct = places.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min(F.struct("hash", "start", "end", "joined")).alias("of"))
    distinct = staged(distinct.select("anchor", "segment", "n", "of.*"), "segments")
    groups = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.col("end") - F.col("start")).alias("group_bytes"), F.max("n").alias("most"), F.max("joined").alias("inner"))
    groups = staged(groups.where("kinds > 1 OR most > 1 OR inner > 0"), "groups")
    open_ = staged(distinct.join(groups, "anchor").drop("most"), "open")
    drop_staged(distinct)

    everything = F.array(F.struct(F.lit(0).alias("start"), (F.col("end") - F.col("start")).alias("end")))
    whole = open_.where("n > 1").select("anchor", "segment", everything.alias("marks"))
    wanted = open_.where("kinds > 1 OR inner > 0").join(counted.select("hash", "rep"), "hash")
    wanted = staged(wanted.select("hash", F.col("rep").alias("doc_id"), "anchor", "segment", "n", "group_bytes", "start", "end"), "wanted")
    # the representative of a text is found by its id too, so copies spread over the join
    match = source.drop("row").join(wanted.withColumnRenamed("hash", "w").withColumnRenamed("doc_id", "rep"), (F.col("hash") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    cut_out = match.select("anchor", "segment", "n", "group_bytes", F.expr("substring(bytes, start + 1, end - start)").alias("part"))
    cut_out = staged(cut_out, "parts")

    marks_schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("marks", SPAN_TYPE)])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; whole groups are gathered up to a batch of bytes."""
        held: list[list] = [[], [], [], []]
        size, last = 0, None

        def done() -> pa.RecordBatch:
            anchor_, segment, several, parts = held
            number = {a: i for i, a in enumerate(dict.fromkeys(anchor_))}
            spans = marked(parts, [number[a] for a in anchor_], several, length)
            rows = [i for i, s in enumerate(spans) if s and not several[i]]
            return pa.RecordBatch.from_arrays([pa.array([anchor_[i] for i in rows], pa.int64()), pa.array([segment[i] for i in rows], pa.int64()), as_structs([spans[i] for i in rows])], schema=marks_schema)

        for batch in batches:
            for a, s, n, group_bytes, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != last and held[0] and size + group_bytes > BATCH_BYTES:
                    yield done()
                    held, size = [[], [], [], []], 0
                last = a
                for column, value in zip(held, (a, s, n > 1, part), strict=True):
                    column.append(value)
                size += len(part)
        if held[0]:
            yield done()

    small = cut_out.where(F.col("group_bytes") <= GROUP_BYTES).repartition("anchor").sortWithinPartitions("anchor")
    by_index = small.select("anchor", "segment", "n", "group_bytes", "part").mapInArrow(index, f"anchor long, segment long, marks {SPANS}")
    by_count = large_groups(cut_out.where(F.col("group_bytes") > GROUP_BYTES), length, k)
    marks = staged(whole.unionByName(by_index).unionByName(by_count), "marks")

    at = places.join(marks, ["anchor", "segment"]).select("hash", "start", F.explode("marks").alias("m"))
    lines = at.select("hash", (F.col("start") + F.col("m.start")).alias("start"), (F.col("start") + F.col("m.end")).alias("end"))
    joined = lines.groupBy("hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one text, bounded by its length
    copied = counted.where("copies > 1").select("hash", F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))).alias("all"))
    spans = counted.select("hash").join(joined, "hash", "left").join(copied, "hash", "left").select("hash", F.coalesce("all", "spans").alias("raw")).where("raw IS NOT NULL")
    spans = staged(spans.select("hash", union_of(F.array_sort("raw")).alias("spans")), "spans")
    empty = F.array().cast(SPANS)
    return source.join(spans, "hash", "left").select(*(c for c in source.columns if c != "hash"), F.coalesce("spans", empty).alias("spans"))


def union_of(spans):
    """Sorted spans, joined where they touch or overlap."""
    start = F.array().cast(SPANS)

    def add(done, s):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), longer).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, start, add)


def windows_at(data: bytes, anchor: int, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of a segment that hold its anchor, the place of the first anchor in each, and the block of the distance."""
    at = np.flatnonzero(string_hashes(np.frombuffer(data, dtype=np.uint8), k).view(np.int64) == anchor)
    start = np.arange(len(data) - length + 1)
    of = np.searchsorted(at, start)
    start, of = start[of < len(at)], of[of < len(at)]
    start, at = start[at[of] + k <= start + length], at[of][at[of] + k <= start + length]
    return start, at, (at - start) // BLOCK


def large_groups(parts: DataFrame, length: int, k: int) -> DataFrame:
    """Marks of groups that exceed one task: hashes of the windows of their segments, counted with map-side sums.

    Most segments of such a group share little more than the anchor. So what all windows of a block have in common, nearly a
    window, is counted first, once for ``BLOCK`` windows; equal windows lie in equal blocks, and only blocks that occur again are hashed
    window by window.
    """
    core_schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("weight", pa.int32()), ("core", pa.binary()), ("at", pa.int32()), ("block", pa.int32())])
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("weight", pa.int32()), ("window", pa.binary()), ("at", pa.int32())])

    def gathered(segments_: Iterator[tuple[list, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Batches of some ten thousand rows from columns, of which single values stand for all of a segment's rows."""
        held: list[list[pa.Array]] = [[] for _ in schema]
        size = 0
        for columns, n in segments_:
            for to, column, f in zip(held, columns, schema, strict=True):
                to.append(pa.array(column, f.type) if isinstance(column, list | np.ndarray) else pa.repeat(pa.scalar(column, f.type), n))
            size += n
            if size > 10_000 or len(held[0]) > 1_000:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in held], schema=schema)
                held, size = [[] for _ in schema], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in held], schema=schema)

    def core_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, int]]:
        for batch in batches:
            for a, s, weight, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, at, block = windows_at(part, a, length, k)
                new = np.ones(len(at), dtype=bool)
                new[1:] = (at[1:] != at[:-1]) | (block[1:] != block[:-1])
                at, block = at[new], block[new]
                last = np.minimum(block * BLOCK + BLOCK - 1, length - k)
                places = zip((at - block * BLOCK).tolist(), (at - last + length).tolist(), block.tolist(), strict=True)
                yield [a, s, weight, [xxhash.xxh3_128_digest(part[i:j], b) for i, j, b in places], at, block], len(at)

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, int]]:
        for batch in batches:
            for a, s, weight, part, live in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start, at, block = windows_at(part, a, length, k)
                start = start[np.isin(at * length + block, [x["at"] * length + x["block"] for x in live])]
                yield [a, s, weight, [xxhash.xxh3_128_digest(part[i : i + length]) for i in start.tolist()], start], len(start)

    def again(rows: DataFrame, name: str) -> DataFrame:
        """Those that a segment not yet marked shares; within a group only: segments of several groups hold the same place of a text."""
        seen = rows.groupBy("anchor", name).agg(F.sum("weight").alias("n"), F.min("weight").alias("least"))
        return staged(seen.where("n > 1 AND least = 1").select("anchor", name), "twice")  # stored, so that a hot one can be split in the join

    parts = parts.select("anchor", "segment", F.least("n", F.lit(2)).cast("int").alias("weight"), "part")  # segments that occur more than once are marked
    blocks = staged(parts.mapInArrow(lambda rows: gathered(core_rows(rows), core_schema), "anchor long, segment long, weight int, core binary, at int, block int"), "cores")
    live = blocks.join(again(blocks, "core"), ["anchor", "core"]).groupBy("anchor", "segment").agg(F.collect_list(F.struct("at", "block")).alias("live"))
    every = parts.join(live, ["anchor", "segment"]).select("anchor", "segment", "weight", "part", "live")
    every = staged(every.mapInArrow(lambda rows: gathered(window_rows(rows), schema), "anchor long, segment long, weight int, window binary, at int"), "windows")
    runs = every.where("weight = 1").join(again(every, "window"), ["anchor", "window"]).select("anchor", "segment", "at")
    # neighbouring starts of one segment, at most its bytes, become one span
    w = Window.partitionBy("anchor", "segment").orderBy("at")
    starts = runs.withColumn("run", F.col("at") - F.row_number().over(w))
    spans = starts.groupBy("anchor", "segment", "run").agg(F.min("at").alias("start"), (F.max("at") + length).cast("int").alias("end"))
    return spans.groupBy("anchor", "segment").agg(F.collect_list(F.struct("start", "end")).alias("marks"))


def cut_spans(data: bytes, spans: list[dict]) -> bytes:
    """What is left of the bytes."""
    at, left = 0, []
    for s in spans:
        left.append(data[at : s["start"]])
        at = s["end"]
    left.append(data[at:])
    return b"".join(left)


def kept(spanned: DataFrame) -> DataFrame:
    """Add ``kept``: the bytes outside of the spans."""
    ready(spanned.sparkSession)
    inside = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get("spans", i - 1)["end"]).alias("from"),
        F.when(i == F.size("spans"), F.octet_length("bytes")).otherwise(F.get("spans", i)["start"]).alias("to"),
    ))
    pieces = F.transform(inside, lambda s: F.substring(F.col("bytes"), s["from"] + 1, s["to"] - s["from"]))
    return spanned.withColumn("kept", F.aggregate(pieces, F.lit(b""), lambda a, b: F.concat(a, b)))
