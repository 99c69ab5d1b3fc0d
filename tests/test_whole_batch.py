"""Whole-batch verdicts from batches that arrive in several files and triggers."""

import random

from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.streaming import monitor, whole

KINDS = {"amount": "numeric", "kind": "categorical"}
SCHEMA = "batch long, amount double, kind string"


def _rows(seed, batch, n, shift):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        amount = None if rng.random() < 0.05 else round(rng.gauss(shift, 1), 2)
        kind = None if rng.random() < 0.05 else rng.choice(["a", "b", "c"] if shift < 1 else ["c", "d"])
        out.append((batch, amount, kind))
    return out


def _plain(rows):
    return [(b, a, k) for b, a, k in rows]


def test_batches_are_judged_once_and_only_when_complete(spark):
    reference = spark.createDataFrame(_rows(1, 0, 300, 0.0), SCHEMA)
    one, two = _rows(2, 1, 240, 0.0), _rows(3, 2, 200, 3.0)
    source, markers = shared_dir(spark, "src"), shared_dir(spark, "markers")
    state, log, check = shared_dir(spark, "state"), shared_dir(spark, "log"), shared_dir(spark, "chk")
    spark.createDataFrame([(1, 240), (2, 200)], "batch long, n_rows long").write.parquet(markers)

    def add(rows, name):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{name}")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", "true"
        ).parquet(source)
        whole.whole_batch_monitor(
            stream, reference, "batch", KINDS, markers, state, log, check, threshold=0.3
        ).awaitTermination()
        return whole.read_log(spark, log)

    add(one[:100], "f1")
    add(one[100:200] + two[:50], "f2")
    assert run().count() == 0  # nothing complete yet
    add(one[200:], "f3")
    assert [r.params["batch_number"] for r in run().collect()] == ["1"]
    add(two[50:], "f4")
    got = run()
    run()  # a restart with nothing new repeats nothing
    got = {r.params["batch_number"]: r for r in whole.read_log(spark, log).collect()}
    assert sorted(got) == ["1", "2"]
    full = spark.createDataFrame(one + two, SCHEMA)
    want = {
        str(r.batch): r for r in monitor.verdict(reference, full, ["batch"], KINDS, 0.3).collect()
    }
    for b in ("1", "2"):
        assert abs(got[b].metrics["drift_share"] - want[b].drift_share) < 1e-9
        assert got[b].tags["status"] == want[b].status


def test_counts_unfold_to_the_same_cells(spark):
    rows = spark.createDataFrame(_rows(5, 7, 500, 0.0) + [(7, float("nan"), None)], SCHEMA)
    counted = whole.cells(rows, "batch", KINDS)
    back = whole.expand(counted, KINDS, ["batch"])
    for f in KINDS:
        a = rows.where(F.col(f).isNotNull() & ~F.isnan(F.col(f)) if f == "amount" else F.col(f).isNotNull())
        assert sorted(x[0] for x in a.select(f).collect()) == sorted(
            x[0] for x in back.where(F.col(f).isNotNull()).select(f).collect()
        )
