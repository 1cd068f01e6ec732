"""Packing pieces into sequences of a fixed capacity by linear grouping.

Only the histogram of lengths, at most one row per token of capacity, reaches the driver. There, large lengths are cut
into groups of equal cardinality and rounded up to the largest of their group; a linear programme over configurations of
these few sizes (columns generated by a knapsack) says how often each configuration is used; its whole part is filled
with actual lengths, and the rest, small lengths included, goes best-fit into the room that is left. The plan is a list
of runs, each saying where consecutive ranks of one length go, so it does not grow with the number of pieces. Ranks are
counted in Spark, in salted buckets of each length, so that no length meets in one task.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUNS = "run_length long, first long, last long, per_bin long, bin long, at long"
#: Longer than such a share of the capacity counts as large; each is tried and the plan with the fewest sequences stays.
LARGE = (1 / 2, 1 / 3, 1 / 4)
GROUPS = 64
SALTS = 256


def groups_of(histogram: dict[int, int], least: float, groups: int) -> list[list[int]]:
    """Large lengths, longest first, cut into groups of about equal cardinality; a length stays in one group."""
    large = sorted((n for n in histogram if n > least), reverse=True)
    each = sum(histogram[n] for n in large) / groups
    out: list[list[int]] = []
    held = np.inf
    for n in large:
        if held >= each:
            out.append([])
            held = 0
        out[-1].append(n)
        held += histogram[n]
    return out


def best_configuration(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity."""
    worth, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    ordered, gains = sizes[order], values[order]
    for room in range(int(ordered[0]), capacity + 1):
        fits = int(np.searchsorted(ordered, room, side="right"))
        options = worth[room - ordered[:fits]] + gains[:fits]
        k = int(np.argmax(options))
        if options[k] > worth[room - 1] + 1e-12:
            worth[room], chosen[room] = options[k], order[k]
        else:
            worth[room] = worth[room - 1]
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
            continue
        counts[chosen[room]] += 1
        room -= int(sizes[chosen[room]])
    return float(worth[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Whole parts of a fractional covering of the demand by configurations, from column generation."""
    basis = np.diag(np.floor(capacity / sizes))
    amounts = demand / np.diag(basis)
    for _ in range(rounds):
        duals = np.linalg.solve(basis.T, np.ones(len(sizes)))
        gain, column = best_configuration(np.maximum(duals, 0), sizes, capacity)
        if gain <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, np.maximum(amounts, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaving]):
            break
        basis[:, leaving] = column
        amounts = np.linalg.solve(basis, demand)
    return [(basis[:, k].astype(int), int(n)) for k, n in enumerate(np.floor(amounts + 1e-9)) if n > 0]


class Plan:
    """Runs of equal bins and the ranks that go to them."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(histogram)
        self.taken: dict[int, int] = defaultdict(int)
        self.bins = 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def put(self, length: int, per_bin: int, first_bin: int, n_bins: int, at: int, n: int | None = None) -> None:
        n = n_bins * per_bin if n is None else n
        first = self.taken[length]
        self.runs.append((length, first, first + n - 1, per_bin, first_bin, at))
        self.taken[length] += n
        self.left[length] -= n

    def leave(self, first_bin: int, n_bins: int, used: int) -> None:
        """Remember bins that have room."""
        room = self.capacity - used
        if room > 0 and n_bins > 0:
            if room not in self.room:
                bisect.insort(self.rooms, room)
            self.room[room].append((first_bin, n_bins))

    def fill(self, groups: list[list[int]], configuration: np.ndarray, n_bins: int) -> None:
        """Use a configuration for so many bins, with the longest actual lengths that each group still has."""
        slots = [g for g, n in enumerate(configuration) for _ in range(n)]
        while n_bins:
            picked, n = [], n_bins
            for g in sorted(set(slots)):
                need, have = slots.count(g), [(x, self.left[x]) for x in groups[g] if self.left[x]]
                x, there = have[0]
                if there >= need:
                    picked += [x] * need
                    n = min(n, there // need)
                else:  # the last few of a length share a bin with the next ones
                    n = 1
                    for x, there in have:
                        picked += [x] * min(there, need)
                        need -= min(there, need)
                        if not need:
                            break
            at = 0
            for x in sorted(set(picked), reverse=True):
                self.put(x, picked.count(x), self.bins, n, at)
                at += x * picked.count(x)
            self.leave(self.bins, n, at)
            self.bins += n
            n_bins -= n

    def best_fit(self, length: int) -> None:
        """Place all that is left of a length, each into the fullest bin that takes it."""
        while self.left[length]:
            k = bisect.bisect_left(self.rooms, length)
            if k == len(self.rooms):
                per_bin = self.capacity // length
                n = self.left[length]
                whole, rest = divmod(n, per_bin)
                if whole:
                    self.put(length, per_bin, self.bins, whole, 0)
                    self.leave(self.bins, whole, per_bin * length)
                if rest:
                    self.put(length, rest, self.bins + whole, 1, 0)
                    self.leave(self.bins + whole, 1, rest * length)
                self.bins += whole + (rest > 0)
                return
            room = self.rooms[k]
            first, n_bins = self.room[room].pop()
            if not self.room[room]:
                del self.room[room]
                self.rooms.pop(k)
            used, per_bin, n = self.capacity - room, room // length, self.left[length]
            whole = min(n_bins, n // per_bin)
            if whole:
                self.put(length, per_bin, first, whole, used)
                self.leave(first, whole, used + per_bin * length)
            rest = min(n - whole * per_bin, per_bin) if whole < n_bins else 0
            if rest:
                self.put(length, rest, first + whole, 1, used)
                self.leave(first + whole, 1, used + rest * length)
            self.leave(first + whole + (rest > 0), n_bins - whole - (rest > 0), used)


def packed(histogram: dict[int, int], capacity: int, groups: int = GROUPS, large: tuple[float, ...] = LARGE) -> Plan:
    """The plan for a histogram of lengths within the capacity: the best over the given shares."""
    return min((planned(histogram, capacity, groups, capacity * share) for share in large), key=lambda plan: plan.bins)


def planned(histogram: dict[int, int], capacity: int, groups: int, least: float) -> Plan:
    plan = Plan(histogram, capacity)
    large = groups_of(histogram, least, groups)
    if large:
        sizes = np.array([g[0] for g in large], dtype=np.int64)
        demand = np.array([sum(histogram[n] for n in g) for g in large], dtype=float)
        for configuration, n in configurations(sizes, demand, capacity):
            left = [sum(plan.left[x] for x in g) for g in large]
            n = min(n, *(left[g] // c for g, c in enumerate(configuration) if c), n)
            plan.fill(large, configuration, n)
    for length in sorted(histogram, reverse=True):
        if length > 0:
            plan.best_fit(length)
    return plan


def pack(pieces: DataFrame, length_col: str, capacity: int, keys: list[str], salts: int = SALTS, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens, in as few sequences as the method finds.

    ``keys`` order pieces of one length and need not be unique: equal rows get places of their own. Pieces whose length is
    null, not positive or above the capacity get null in both columns. Input columns are kept; a clash with the two new
    names is an error of the caller. No rows: no rows. ``pieces`` is read three times, so hand over a stored table.
    """
    spark = pieces.sparkSession
    order = [f"key_{i}" for i in range(len(keys))]
    # the caller's columns travel in one struct, so that no name of theirs meets one of ours
    rows = pieces.select(F.struct(*pieces.columns).alias("row"), F.col(length_col).alias("length"), *[F.col(k).alias(o) for k, o in zip(keys, order, strict=True)])
    fits = F.col("length").between(1, capacity)
    histogram = {r[0]: r[1] for r in rows.where(fits).groupBy(F.col("length").cast("long")).count().collect()}  # at most `capacity` rows
    plan = packed(histogram, capacity, groups)
    runs = spark.createDataFrame(plan.runs, RUNS)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = salted.where(fits).groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # at most `salts` rows of a length
    place = Window.partitionBy("length", "salt").orderBy(*order)
    ranked = salted.withColumn("place", F.row_number().over(place) - 1).join(starts, ["length", "salt"], "left")
    ranked = ranked.withColumn("rank", F.col("place") + F.col("start"))
    met = (F.col("length") == F.col("run_length")) & F.col("rank").between(F.col("first"), F.col("last"))
    placed = ranked.join(F.broadcast(runs), met, "left")  # a bounded number of runs for each length
    index = F.col("rank") - F.col("first")
    return placed.select(
        "row.*",
        (F.col("bin") + F.floor(index / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(index, F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def pieces_of(coded: DataFrame, capacity: int, end_id: int, id_col: str = "doc_id") -> DataFrame:
    """Cut encoded documents, each closed by ``end_id``, into pieces of the capacity; the first piece may be shorter.

    ``coded`` has the id and binary ``ids``. Returns the id, ``piece``, ``start``, ``length`` and ``piece_ids`` (binary). A null or
    empty document is the closing id alone; repeated rows are cut alike.
    """
    closing = end_id.to_bytes(4, "little")
    whole = F.concat(F.coalesce("ids", F.lit(b"")), F.lit(closing))
    n = F.octet_length("_ids") / 4
    first = F.pmod(n - 1, F.lit(capacity)) + 1
    cut = coded.select(id_col, whole.alias("_ids")).select(id_col, "_ids", n.cast("long").alias("_n"), first.cast("long").alias("_first"))
    cut = cut.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / capacity).cast("long"))).alias("piece", "_k"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("_first") + (F.col("piece") - 1) * capacity).cast("long")
    length = F.when(F.col("piece") == 0, F.col("_first")).otherwise(capacity).cast("long")
    bounds = cut.select(id_col, "piece", start.alias("start"), length.alias("length"), "_ids")
    return bounds.select(id_col, "piece", "start", "length", F.expr("substring(_ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("piece_ids"))

