"""All batches of events are compared with batch 0."""

import datetime

from suite.common import events_by_batch


def test_later_batches_are_kept(spark, tmp_path):
    first = datetime.datetime(2024, 1, 1)
    rows = [(i, i, "view", float(i), first + datetime.timedelta(days=5 * i)) for i in range(9)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts timestamp_ntz")
    df.write.parquet(f"{tmp_path}/events.parquet")
    out = events_by_batch(spark, str(tmp_path)).collect()
    assert sorted((r.batch_number, r.is_ref) for r in out) == [(i, i == 0) for i in range(9)]
