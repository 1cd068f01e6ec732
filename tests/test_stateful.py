"""Detection with keyed state against the batch operators, under arrival out of order."""

import random
from dataclasses import replace
from datetime import timedelta

import pandas as pd
import pytest

from tests.tracks import SCHEMA, T0, approach, circling
from trackflow.config import TrackRules
from trackflow.operators.episodes import conform, episodes
from trackflow.streaming import etl, stateful

RULES = replace(TrackRules(), chunk_s=600)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("chunk_s", [600, 3600])
def test_shuffled_arrival_gives_the_batch_result(spark, tmp_path, chunk_s):
    rules = replace(RULES, chunk_s=chunk_s)
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "c"))
    rows = circling(laps=9, key="long") + circling(laps=2, key="late", start=T0 + timedelta(minutes=20)) + approach("27L", [(240, -700, False), (60, 1800, False), (120, 1500, False)], key="away")
    rows += [(*r[:1], None, *r[2:]) for r in circling(laps=3, key="same")] + circling(laps=3, key="same") + [("none", "N", T0, None, None, None, None, None, None)]
    rng = random.Random(chunk_s)
    arrival = sorted((r[2] + timedelta(seconds=rng.randint(0, 110)), k) for k, r in enumerate(rows))
    cuts = [0, len(rows) // 3, len(rows) // 2, len(rows)]
    parts = [[rows[k] for _, k in arrival[a:b]] for a, b in zip(cuts, cuts[1:])]
    clock = ("clock", None, T0 + timedelta(days=1), *[None] * 6)
    for part in (*parts, [clock]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            query = stateful.detect_stateful(etl.table_stream(spark, source, SCHEMA), log, checkpoint, rules)
            query.awaitTermination()
    want = rows_of(conform(episodes(spark.createDataFrame(rows, SCHEMA), rules)))
    assert rows_of(conform(stateful.logged_episodes(spark, log, rules))) == want and len(want) >= 4
    left = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert not left or left[-1] <= 1  # only the clock still waits


def test_equal_reports_are_one_row_of_state():
    one = pd.DataFrame({"us": [5, 5, 6], "lat": [1.0, 1.0, None], "name": ["a", "a", None], "copies": [1, 1, 1]})
    rows = stateful.merged([one, stateful.unpacked(stateful.packed(one))])
    assert sorted(rows["copies"]) == [2, 4] and len(rows) == 2


def test_many_keys_share_a_row_of_state_and_stay_apart(spark, tmp_path):
    """State and calls into Python are bounded by the groups, not by the keys."""
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "c"))
    keys = [f"{k:06x}" for k in range(12)]
    rows = [r for k, key in enumerate(keys) for r in circling(laps=3 + k % 3, key=key, start=T0 + timedelta(minutes=7 * k))]
    rows += circling(laps=3, key="", start=T0) + [(None, "N", *rows[0][2:]), (*rows[0][:2], None, *rows[0][3:])]
    held = []
    for part in (rows[::2], rows[1::2], [("clock", None, T0 + timedelta(days=1), *[None] * 6)]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        query = stateful.detect_stateful(etl.table_stream(spark, source, SCHEMA), log, checkpoint, RULES, delay="3 hours", groups=2)
        query.awaitTermination()
        held += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    known = [r for r in rows if r[0] is not None]
    want = rows_of(conform(episodes(spark.createDataFrame(known, SCHEMA), RULES)))
    assert rows_of(conform(stateful.logged_episodes(spark, log, RULES))) == want and len(want) >= len(keys)
    assert max(held) == 2
