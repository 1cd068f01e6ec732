"""Folds of a change log batch by batch against the fold of the whole log."""

import random

import pytest

from trackflow.operators import cdc
from trackflow.streaming import changes, etl

SCHEMA = "event_id string, event_type string, location string, status string, duration_s int, trigger_ts timestamp, first_detected_at timestamp, _pg_change_type string, _timestamp timestamp, _sort_by long"


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("compacts", [False, True])
def test_batches_in_any_order_give_the_whole_fold(spark, tmp_path, compacts):
    source, folds, checkpoint = (str(tmp_path / n) for n in ("log", "folds", "c"))
    rng = random.Random(7)
    t = lambda: rng.choice([None, *spark_times])
    spark_times = [r[0] for r in spark.sql("SELECT timestamp_seconds(1700000000 + id * 60) FROM range(40)").collect()]
    kinds = ["insert", "update_preimage", "update_postimage", "update_postimage", "delete"]
    rows = [(rng.choice([None, *"abcdefgh"]), "holding", rng.choice("XY"), rng.choice(["detected", "assessed", "confirmed"]), n, t(), t(), rng.choice(kinds), t(), n) for n in range(120)]
    rows += [("z", "holding", "X", "detected", 1, None, None, "delete", None, 500), ("z", "holding", "X", "detected", 1, None, None, "insert", None, 400)]
    mixed = rng.sample(rows, len(rows))
    for k, part in enumerate((mixed[:50], mixed[50:], mixed[20:70])):  # the third repeats what came
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        changes.follow_changes(etl.table_stream(spark, source, SCHEMA), folds, "event_id", checkpoint).awaitTermination()
        if compacts and k < 2:
            changes.compact(spark, folds, "event_id")
            assert [p.name for p in (tmp_path / "folds" / "states").iterdir() if p.is_dir()] == [f"batch_id={-1 - k}"]
    log = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(changes.current(spark, folds, "event_id")) == rows_of(cdc.current_rows(log, "event_id"))
    assert rows_of(changes.lifecycles(spark, folds)) == rows_of(cdc.lifecycle(log))
    again = str(tmp_path / "again")  # a lost checkpoint folds all as batch 0
    changes.follow_changes(etl.table_stream(spark, source, SCHEMA), folds, "event_id", again).awaitTermination()
    assert rows_of(changes.current(spark, folds, "event_id")) == rows_of(cdc.current_rows(log, "event_id"))
