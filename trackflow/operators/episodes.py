"""Episode detection: sustained circling near a stack, and aborted approaches.

Everything runs as windows over (key, chunk) and grouped aggregates; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow import schemas
from trackflow.config import EPISODE_KINDS, TrackRules
from trackflow.functions.geo import point_id
from trackflow.functions.text import episode_id
from trackflow.functions.times import SECOND, micros
from trackflow.operators.joins import interval_join
from trackflow.operators.tracks import (
    MICRODEGREE,
    chunk_window,
    degrees,
    in_stack_zone,
    is_climbing,
    is_low,
    starts_run,
    track_frames,
    usable_reports,
)
from trackflow.operators.windows import run_starts

SPREAD = -1  # stitch slot of pieces that touch a chunk border; whole pieces use their own chunk


def visit_windows(rules: TrackRules, keys: Sequence[str]) -> list[Column]:
    """Neighbour facts needed to number visits."""
    w, zone = chunk_window(keys), in_stack_zone(rules)
    return [
        F.lag(zone, 1, False).over(w).alias("zone_before"),
        F.lead(zone, 1, False).over(w).alias("zone_after"),
        F.lead("gap_s").over(w).alias("gap_after"),
        F.lag("home", 1, True).over(w).alias("home_before"),
        F.lead("home", 1, True).over(w).alias("home_after"),
    ]


def with_visits(frames: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Number the visits inside each chunk and mark those that run over a border.

    A visit ends when the key leaves the zone or falls silent for longer than the visit gap; both
    are judged on the whole track, before rows outside the zone are put aside.
    """
    zone = in_stack_zone(rules)
    opens = zone & (~F.col("zone_before") | (F.col("gap_s") > rules.visit_gap_s))
    goes_on = zone & F.col("zone_after") & (F.col("gap_after") <= rules.visit_gap_s)
    to_here = chunk_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    return frames.select(
        "*",
        (zone & F.col("home")).alias("in_visit"),
        (zone & ~opens & ~F.col("home_before")).alias("from_before"),
        F.coalesce(goes_on & ~F.col("home_after"), F.lit(False)).alias("into_next"),
        F.sum(F.when(opens, 1).otherwise(0)).over(to_here).alias("piece"),
    )


def approach_windows(rules: TrackRules, keys: Sequence[str]) -> list[Column]:
    """What came before each report, and how many strong climbs the chunk has seen before it."""
    c, w = rules.columns, chunk_window(keys)
    earlier = w.rangeBetween(-rules.arrival_window_s * SECOND, -1)
    climbs = F.sum(is_climbing(rules).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return [
        starts_run(is_low(rules), keys).alias("first_low"),
        F.max(c.ground).over(earlier).alias("ground_before"),
        F.max(c.alt).over(earlier).alias("alt_before"),
        F.coalesce(climbs, F.lit(0)).alias("stretch"),
    ]


def with_approaches(frames: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Measure, from every report, the stretch up to and including the next strong climb.

    Reports between two climb reports share a group; reading a group backwards, a running
    aggregate covers exactly the stretch from the current report to the climb that ends it.
    """
    c = rules.columns
    backwards = (
        Window.partitionBy(*keys, "chunk", "stretch")
        .orderBy(F.col("us").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    measured = frames.select(
        "*",
        F.first("us").over(backwards).alias("end_us"),
        F.first(is_climbing(rules)).over(backwards).alias("end_climbs"),
        F.max(c.ground).over(backwards).alias("grounded"),
        F.min(c.alt).over(backwards).alias("seg_low"),
        F.max(c.alt).over(backwards).alias("seg_high"),
        F.sum(F.abs("turn_micro")).over(backwards).alias("seg_turn"),
        F.count(F.lit(1)).over(backwards).alias("seg_rows"),
    )
    arrival = F.col("first_low") & ~F.col("ground_before") & (
        F.col("alt_before") >= F.col(c.alt) + rules.arrival_drop_ft
    )
    away = F.col("end_climbs") & ~F.col("grounded") & (
        F.col("end_us") <= F.col("us") + rules.climb_window_s * SECOND
    )
    return measured.withColumn("aborted", F.coalesce(F.col("home") & arrival & away, F.lit(False)))


def _part(kind: str, piece, us_end, trigger, low, high, turn, rows, place, from_before, into_next) -> Column:
    """Contribution of one report to an episode; both kinds share one layout."""
    return F.struct(
        F.lit(EPISODE_KINDS.index(kind)).alias("kind"),
        piece.cast("long").alias("piece"),
        F.col("us").alias("us_start"),
        us_end.alias("us_end"),
        trigger.alias("us_trigger"),
        low.alias("low"),
        high.alias("high"),
        turn.alias("turn"),
        rows.cast("long").alias("rows"),
        place.alias("place"),
        from_before.alias("from_before"),
        into_next.alias("into_next"),
    )


def neighbour_facts(rules: TrackRules, keys: Sequence[str], kinds: Sequence[str]) -> list[Column]:
    """The windows that the kinds need beside the track features."""
    holding, aborting = "holding" in kinds, "go_around" in kinds
    return [*(visit_windows(rules, keys) if holding else ()), *(approach_windows(rules, keys) if aborting else ())]


def _contributions(df: DataFrame, rules: TrackRules, by: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    keys = [*by, rules.columns.key]
    return contributions_of(track_frames(df, rules, by, also=neighbour_facts(rules, keys, kinds)), rules, keys, kinds)


def contributions_of(frames: DataFrame, rules: TrackRules, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    c = rules.columns
    holding, aborting = "holding" in kinds, "go_around" in kinds
    us, alt, no = F.col("us"), F.col(c.alt), F.lit(False)
    parts = []
    if holding:
        frames = with_visits(frames, rules, keys)
        turn = F.abs("cum_micro")
        part = _part(
            "holding", F.col("piece"), us, F.when(turn >= rules.hold_turn_deg * MICRODEGREE, us), alt, alt, turn,
            F.lit(1), F.col("stack_rank"), F.col("from_before"), F.col("into_next"),
        )
        parts.append(F.when(F.col("in_visit"), part))
    if aborting:
        frames = with_approaches(frames, rules, keys)
        part = _part(
            "go_around", us, F.col("end_us"), F.col("end_us"), F.col("seg_low"), F.col("seg_high"),
            F.col("seg_turn"), F.col("seg_rows"), F.col("rwy_rank"), no, no,
        )
        parts.append(F.when(F.col("aborted"), part))
    exploded = frames.select(*keys, "chunk", F.explode(F.array(*parts)).alias("part"))
    return exploded.where("part IS NOT NULL").select(*keys, "chunk", "part.*")


def _folds(tallies: Sequence[str]) -> list[Column]:
    """How rows of one piece, and later pieces of one visit, combine. All buffers are fixed width."""
    lowest = [F.min(n).alias(n) for n in ("us_start", "us_trigger", "low")]
    highest = [F.max(n).alias(n) for n in ("us_end", "high", "turn", "place")]
    return [*lowest, *highest, F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in tallies]]


def _tallies(rules: TrackRules) -> list[str]:
    return [f"at_{i}" for i in range(len(rules.stacks))]


def pieces_of(parts: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Fold the reports of a chunk into pieces of episodes; needs no shuffle, rows already sit by key and chunk."""
    tallies = _tallies(rules)
    counted = parts.select("*", *[F.when(F.col("place") == i, 1).otherwise(0).alias(n) for i, n in enumerate(tallies)])
    return counted.groupBy(*keys, "chunk", "kind", "piece").agg(
        *_folds(tallies), F.max("from_before").alias("from_before"), F.max("into_next").alias("into_next")
    )


def _joined_pieces(pieces: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Join the pieces of visits that cross chunk borders.

    Only pieces touching a border meet in one partition per key, at most two per chunk; all others stay spread out.
    """
    tallies = _tallies(rules)
    border = F.col("from_before") | F.col("into_next")
    group = [*keys, "kind", "slot"]
    in_order = Window.partitionBy(*group).orderBy("us_start").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.last(F.when(~F.col("from_before"), F.col("us_start")), ignorenulls=True).over(in_order)
    return (
        pieces.withColumn("slot", F.when(border, F.lit(SPREAD)).otherwise(F.col("chunk")))
        .withColumn("visit", F.when(border, begun).otherwise(F.col("us_start")))
        .groupBy(*group, "visit")
        .agg(*_folds(tallies))
    )


def visits(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """All stack visits, whether or not they circled."""
    keys = [*by, rules.columns.key]
    return _joined_pieces(pieces_of(_contributions(df, rules, by, ["holding"]), rules, keys), rules, keys).select(
        *keys,
        F.timestamp_micros("us_start").alias("started_at"),
        F.timestamp_micros("us_end").alias("ended_at"),
        F.col("rows").alias("n_points"),
        degrees(F.col("turn")).alias("max_turn_deg"),
    )


def key_summary(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """Usable reports and last known name per key (partial aggregation, safe for busy keys)."""
    c = rules.columns
    named = F.when(F.col(c.name).isNotNull(), F.struct(c.ts, c.name))
    return (
        usable_reports(df, rules)
        .groupBy(*by, c.key)
        .agg(F.count(F.lit(1)).alias("reports"), F.max(named).alias("named"))
        .select(*by, c.key, "reports", F.trim(F.col("named")[c.name]).alias("last_name"))
    )


def most_common_stack(rules: TrackRules) -> Column:
    """The stack most reports were nearest to; the alphabetically first one among equals."""
    in_name_order = sorted(range(len(rules.stacks)), key=lambda i: rules.stacks[i].id)
    tallies = [
        F.struct(F.col(f"at_{i}").alias("n"), F.lit(-order).alias("order"), F.lit(rules.stacks[i].id).alias("id"))
        for order, i in enumerate(in_name_order)
    ]
    return F.array_max(F.array(*tallies))["id"]


def episodes(
    df: DataFrame,
    rules: TrackRules = TrackRules(),
    by: Sequence[str] = (),
    kinds: Sequence[str] = EPISODE_KINDS,
) -> DataFrame:
    """Episodes of the given kinds in the published 13-column layout (plus ``by``).

    One pass over the tracks serves both kinds.
    """
    pieces = pieces_of(_contributions(df, rules, by, kinds), rules, [*by, rules.columns.key])
    return episodes_of_pieces(pieces, key_summary(df, rules, by), rules, by)


def episodes_of_pieces(pieces: DataFrame, summary: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """Episodes from the pieces of all chunks and one row per key with its ``reports`` and ``last_name``."""
    c = rules.columns
    keys = [*by, c.key]
    folded = _joined_pieces(pieces, rules, keys)
    holding = F.col("kind") == EPISODE_KINDS.index("holding")
    kind = F.get(F.array(*[F.lit(k) for k in EPISODE_KINDS]), F.col("kind"))
    started = F.timestamp_micros("us_start")
    return (
        folded.where(~holding | F.col("us_trigger").isNotNull())
        .join(summary.where(F.col("reports") >= rules.min_reports), keys)
        .select(
            *by,
            episode_id(F.col(c.key), kind, started).alias("event_id"),
            kind.alias("event_type"),
            F.col(c.key).cast("string").alias("icao24"),
            F.col("last_name").alias("callsign"),
            F.when(holding, most_common_stack(rules))
            .otherwise(point_id(F.col("place"), rules.runways))
            .alias("location"),
            started.alias("started_at"),
            F.timestamp_micros("us_end").alias("ended_at"),
            F.floor((F.col("us_end") - F.col("us_start")) / SECOND).alias("duration_s"),
            F.timestamp_micros("us_trigger").alias("trigger_ts"),
            F.col("low").cast("double").alias("min_alt_ft"),
            F.col("high").cast("double").alias("max_alt_ft"),
            degrees(F.col("turn")).alias("max_turn_deg"),
            F.col("rows").alias("n_points"),
        )
    )


def since(df: DataFrame, window_start: Column, rules: TrackRules = TrackRules()) -> DataFrame:
    """Reports after the start of a look-back window."""
    return df.where(F.col(rules.columns.ts) > window_start)


def settled(found: DataFrame, window_start: Column, rules: TrackRules = TrackRules()) -> DataFrame:
    """Drop episodes starting so near the window's left edge that their true start may be cut off."""
    return found.where(F.col("started_at") >= window_start + F.make_dt_interval(secs=F.lit(float(rules.edge_margin_s))))


def episodes_in_window(df: DataFrame, window_start: Column, rules: TrackRules = TrackRules()) -> DataFrame:
    return settled(episodes(since(df, window_start, rules), rules), window_start, rules)


def redetected_in_copies(
    df: DataFrame, first: Column, last: Column, step_s: int, rules: TrackRules = TrackRules()
) -> DataFrame:
    """As ``redetected_ids``, by copying every report to the windows it falls in; for rules under which windows share nothing."""
    ts = micros_of(rules)
    step, look = step_s * SECOND, rules.lookback_s * SECOND
    first_us, last_us = F.unix_micros(first), F.unix_micros(last)
    # Window n ends at first + n * step and holds reports in (end - look-back, end].
    lowest = F.greatest(F.lit(0), F.ceil((ts - first_us) / step))
    highest = F.least(F.floor((last_us - first_us) / step), F.ceil((ts + look - first_us) / step) - 1)
    spread = (
        df.withColumn("lo", lowest)
        .withColumn("hi", highest)
        .where("lo <= hi")
        .select(*df.columns, F.explode(F.sequence("lo", "hi")).alias("window_no"))
    )
    start = F.timestamp_micros(first_us + F.col("window_no") * step - look)
    return (
        settled(episodes(spread, rules, by=["window_no"]), start, rules)
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("windows"), F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
    )


def windows_share(rules: TrackRules) -> bool:
    """Whether an episode found once tells what every window sees of it.

    The guard must be no shorter than what a visit or an arrival looks back on, and the rules must imply the least number of reports.
    """
    guarded = rules.edge_margin_s >= max(rules.visit_gap_s, rules.arrival_window_s)
    return guarded and rules.min_reports <= 3 and rules.hold_turn_deg > 180 * (rules.min_reports - 2)


def redetected_ids(
    df: DataFrame, first: Column, last: Column, step_s: int, rules: TrackRules = TrackRules()
) -> DataFrame:
    """Distinct episodes over a series of look-back windows ending at first, first + step, ... last.

    Episodes are found once over all reports. A window that begins further before an episode than any rule looks back sees the same
    start and turns, so which of these windows count it, and how far the last of them sees it, follows from its start, trigger and end
    alone. Only windows that begin just before a visit or a low run are evaluated again, on the reports from their
    left edge to the end of that visit or run; with a guard as long as the look-back there are none.
    """
    if not windows_share(rules):
        return redetected_in_copies(df, first, last, step_s, rules)
    c = rules.columns
    step, look, margin, back = step_s * SECOND, rules.lookback_s * SECOND, rules.edge_margin_s * SECOND, rules.back_s * SECOND
    first_us, last_us = F.unix_micros(first), F.unix_micros(last)
    newest = F.floor((last_us - first_us) / step)
    end_of = lambda n: first_us + n * step
    inside = usable_reports(df, rules).where((micros_of(rules) > first_us - look) & (micros_of(rules) <= end_of(newest)))

    start, end, trigger = (F.unix_micros(n) for n in ("started_at", "ended_at", "trigger_ts"))
    holding = F.col("event_type") == "holding"
    found = episodes(inside, rules).select("event_id", "event_type", F.col("icao24").alias(c.key), start.alias("s"), end.alias("e"), trigger.alias("seen"))
    lowest = F.greatest(F.lit(0), F.ceil((F.col("seen") - first_us) / step))
    whole_left = F.ceil((F.col("s") - back + look - first_us) / step) - 1
    settled_left = F.floor((F.col("s") - margin + look - first_us) / step)
    shared = found.select("*", lowest.alias("lo"), F.least(newest, whole_left, settled_left).alias("hi")).where("lo <= hi")
    shared = shared.withColumn("until", F.when(holding, F.least(F.col("e"), end_of(F.col("hi")))).otherwise(F.col("e")))
    # a visit that its last window cuts ends there with the last report up to the window's end
    cut = shared.where("until < e").select("event_id", c.key, F.timestamp_micros(F.col("until") - rules.visit_gap_s * SECOND).alias("from"), F.timestamp_micros("until").alias("to"))
    at = inside.select(F.col(c.key).cast("string").alias(c.key), F.col(c.ts).alias("at"))
    ends = interval_join(cut, at, F.col("from"), F.col("to"), "at", on=[c.key]).groupBy("event_id").agg(F.max(micros(F.col("at"))).alias("cut_end"))
    shared = shared.join(ends, "event_id", "left").select("event_id", (F.col("hi") - F.col("lo") + 1).alias("windows"), "s", F.coalesce("cut_end", "until").alias("e"))

    # windows that begin between the guard and the look-back before a possible start
    runs = run_starts(inside, rules).select(c.key, micros(F.col(c.ts)).alias("s"), (micros(F.col(c.ts)) + rules.ahead_s * SECOND).alias("stop"))
    starts = visits(inside, rules).select(c.key, start.alias("s"), end.alias("stop")).unionByName(runs)
    nearest_left = F.greatest(F.lit(0), F.ceil((F.col("s") - back + look - first_us) / step), F.ceil((F.col("s") - first_us) / step))
    edges = starts.select(c.key, "stop", nearest_left.alias("lo"), F.least(newest, settled_left).alias("hi")).where("lo <= hi")
    edges = edges.select(c.key, "stop", F.explode(F.sequence("lo", "hi")).alias("window_no")).groupBy(c.key, "window_no").agg(F.max("stop").alias("stop"))
    begin, stop = end_of(F.col("window_no")) - look, F.least(F.col("stop"), end_of(F.col("window_no")))
    again = interval_join(edges, inside, F.timestamp_micros(begin + 1), F.timestamp_micros(stop), c.ts, on=[c.key], bucket_s=rules.chunk_s)
    left = end_of(F.col("window_no")) - look
    at_edge = episodes(again, rules, by=["window_no"]).where((start >= left + margin) & (start <= left + back))
    at_edge = at_edge.select("event_id", F.lit(1).cast("long").alias("windows"), start.alias("s"), end.alias("e"))
    return (
        shared.unionByName(at_edge)
        .groupBy("event_id")
        .agg(F.sum("windows").alias("windows"), F.timestamp_micros(F.min("s")).alias("started_at"), F.timestamp_micros(F.max("e")).alias("ended_at"))
    )


def micros_of(rules: TrackRules) -> Column:
    return F.unix_micros(F.col(rules.columns.ts).cast("timestamp"))


def conform(found: DataFrame) -> DataFrame:
    """Cast to the published episode schema."""
    return found.select(*[F.col(p.split()[0]).cast(p.split()[1].lower()) for p in schemas.EPISODES.split(", ")])
