"""Episode detection on a stream with keyed state: every report is evaluated once, and no history is read again.

State holds the newest reports, one row for each group of keys (``groups`` of them, by a hash of the key), so a call into Python
serves many keys and its cost follows the reports, not the number of keys. Once the watermark has passed the end of a time chunk and
what rules look ahead, nothing can still arrive for it: its reports leave with their neighbours before and behind, in the layout in
which batch detection cuts tracks, and state keeps only what later chunks look back on. So reports may arrive in any order within the
delay, and state is bounded by the chunk, the look-back and the look-ahead, not by the history. The windows over a chunk run as the
same DataFrame operators as in a batch; their pieces of episodes go to a log, and episodes are a fold of it, in which
visits over chunk borders are joined. A repeated batch replaces its own pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trackflow.config import EPISODE_KINDS, TrackRules
from trackflow.functions.times import SECOND, micros
from trackflow.operators import episodes as E
from trackflow.operators.tracks import chunk_frames, placed_reports

STATE = "held BINARY, next_chunk BIGINT"
GROUPS = 256  # at 36 million waiting reports a group holds 140,000 of them, so a task needs tens of megabytes


def packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.BufferReader(held)).read_all().to_pandas()


def merged(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """All reports with ``copies``: equal ones are one row, so a source that repeats itself does not enlarge the state."""
    rows = pd.concat(parts, ignore_index=True)
    names = [n for n in rows.columns if n != "copies"]
    return rows.groupby(names, dropna=False, sort=False, as_index=False)["copies"].sum()[[*names, "copies"]]


def settled_chunks(positions: DataFrame, rules: TrackRules = TrackRules(), delay: str = "2 minutes", groups: int = GROUPS) -> DataFrame:
    """Reports of finished chunks: key, ``us``, the report's columns, ``copies``, and ``chunk`` and ``home`` as in ``in_chunks``.

    Rows at or behind the watermark are dropped by Spark; all others wait for their chunk. A key's chunk without reports of
    its own is not made. Reports without key or time are left out. ``groups`` must stay the same for the life of a checkpoint.
    """
    c = rules.columns
    size, back, ahead = (s * SECOND for s in (rules.chunk_s, rules.back_s, rules.ahead_s))
    values = (c.name, c.lat, c.lon, c.alt, c.vr, c.track, c.ground)
    stream = positions.withWatermark(c.ts, delay).where(F.col(c.key).isNotNull() & F.col(c.ts).isNotNull())
    key = F.col(c.key).cast("string")
    group = F.pmod(F.xxhash64(key), F.lit(groups)).alias("key_group")
    reports = stream.select(group, key.alias(c.key), micros(F.col(c.ts)).alias("us"), *values, F.lit(1).cast("long").alias("copies"), c.ts)
    types = dict(reports.dtypes)
    held_columns = [c.key, "us", *values, "copies"]
    out = [*held_columns, "chunk", "home"]
    schema = ", ".join(f"{n} {types.get(n, 'boolean' if n == 'home' else 'bigint')}" for n in out)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, next_chunk = state.get if state.exists else (None, None)
        parts = [unpacked(held)] if held is not None else []
        parts += [f[held_columns] for f in frames]
        if not parts:
            return
        rows = merged(parts).sort_values("us", kind="stable", ignore_index=True)
        us = rows["us"].to_numpy()
        own = us // size
        done = (state.getCurrentWatermarkMs() * 1000 - ahead) // size  # chunks below are finished
        begun = own[0] if next_chunk is None else next_chunk
        for chunk in np.unique(own[(own >= begun) & (own < done)]):
            near = rows.iloc[us.searchsorted(chunk * size - back) : us.searchsorted((chunk + 1) * size + ahead)].copy()
            near["chunk"] = chunk
            near["home"] = near["us"] // size == chunk
            yield near.loc[near[c.key].isin(near.loc[near["home"], c.key]), out]
        begun = max(begun, done)
        rows = rows[us >= begun * size - back]
        if rows.empty:
            state.remove()
            return
        waiting = rows["us"][rows["us"] >= begun * size]
        # the end of the next chunk with reports, or the time when no chunk looks back on the last of them
        due = (waiting.min() // size + 1) * size + ahead if len(waiting) else rows["us"].max() + back + size + ahead
        state.update((packed(rows), int(begun)))
        state.setTimeoutTimestamp(max(-(-int(due) // 1000), state.getCurrentWatermarkMs() + 1))

    return reports.groupBy("key_group").applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def chunk_pieces(chunks: DataFrame, rules: TrackRules = TrackRules(), kinds=EPISODE_KINDS) -> DataFrame:
    """Pieces of the episodes in finished chunks; of several reports of an instant the smallest counts, as in a batch."""
    c = rules.columns
    known = chunks.where(" AND ".join(f"{n} IS NOT NULL" for n in (c.lat, c.lon, c.alt)))
    unique = known.groupBy(c.key, "chunk", "home", "us").agg(F.min(F.struct(c.lat, c.lon, c.alt, c.vr, c.track, c.ground)).alias("report"), F.max(c.name).alias(c.name))
    placed = placed_reports(unique.select(c.key, "chunk", "home", "us", c.name, "report.*"), rules, [c.key, "chunk", "home"])
    frames = chunk_frames(placed, rules, [c.key], also=E.neighbour_facts(rules, [c.key], kinds))
    return E.pieces_of(E.contributions_of(frames, rules, [c.key], kinds), rules, [c.key])


def chunk_summary(chunks: DataFrame, rules: TrackRules = TrackRules()) -> DataFrame:
    """Usable reports and the last name of each key in finished chunks."""
    c = rules.columns
    named = F.when(F.col(c.name).isNotNull(), F.struct("us", F.col(c.name).alias("name")))
    known = chunks.where(" AND ".join(["home", *(f"{n} IS NOT NULL" for n in (c.lat, c.lon, c.alt))]))
    return known.groupBy(c.key).agg(F.sum("copies").alias("reports"), F.max(named).alias("named"))


def detect_stateful(
    positions: DataFrame, log: str, checkpoint: str, rules: TrackRules = TrackRules(), delay: str = "2 minutes", every: str | None = None, groups: int = GROUPS
) -> StreamingQuery:
    """Log the pieces of episodes of a stream of positions below ``log``; ``groups`` as in ``settled_chunks``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)  # read twice; lost blocks are made again from the same state
        try:
            chunk_pieces(batch, rules).write.mode("overwrite").parquet(f"{log}/pieces/batch_id={batch_id}")
            chunk_summary(batch, rules).write.mode("overwrite").parquet(f"{log}/summary/batch_id={batch_id}")
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = settled_chunks(positions, rules, delay, groups).writeStream.foreachBatch(on_batch).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def logged_episodes(spark: SparkSession, log: str, rules: TrackRules = TrackRules()) -> DataFrame:
    """Episodes of all finished chunks, as ``episodes`` finds them in the same reports."""
    c = rules.columns
    summary = spark.read.parquet(f"{log}/summary").groupBy(c.key).agg(F.sum("reports").alias("reports"), F.max("named").alias("named"))
    summary = summary.select(c.key, "reports", F.trim("named.name").alias("last_name"))
    return E.episodes_of_pieces(spark.read.parquet(f"{log}/pieces").drop("batch_id"), summary, rules)
