"""Incremental ingest (Structured Streaming, availableNow) and upsert."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators.expectations import observe_violations
from starloom.sources import readers as R
from starloom.streaming.incremental import ingest_stream, new_arrivals, upsert_latest, upsert_partitions
from starloom.streaming.snapshots import Conflict, SnapshotTable


def _write_ndjson(path, rows):
    with open(path, "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_stream_ingests_each_file_once(spark, tmp_dir):
    src, bronze, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    t = lambda i: {"ticket_id": f"T{i}", "status": "open", "created_at": "2025-01-01"}
    _write_ndjson(os.path.join(src, "a.json"), [t(1), t(2)])
    ingest_stream(spark, src, R.TICKETS_SCHEMA, "json", bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 2
    _write_ndjson(os.path.join(src, "b.json"), [t(3)])
    ingest_stream(spark, src, R.TICKETS_SCHEMA, "json", bronze, ckpt)
    back = spark.read.parquet(bronze)
    assert sorted(r[0] for r in back.select("ticket_id").collect()) == ["T1", "T2", "T3"]
    assert back.select("batch_id").distinct().count() == 2
    assert back.where(F.col("_source_file").endswith("b.json")).count() == 1


def test_late_equal_and_undated_rows_are_kept(spark):
    target = spark.createDataFrame([("A", "2024-01-02", 1)], "k string, stamp string, _ingested_at int")
    arrivals = spark.createDataFrame([("B", "2024-01-02", 2), ("C", None, 2), ("D", "2024-01-01", 2), ("E", "2024-01-03", 1),
                                      ("F", "2024-01-03", None)], "k string, stamp string, _ingested_at int")
    new = new_arrivals(arrivals, target.agg(F.max("_ingested_at")).scalar())
    assert sorted(r["k"] for r in new.collect()) == ["B", "C", "D", "F"]
    out = upsert_latest(target, new, ["k"], "stamp")
    assert sorted(r["k"] for r in out.collect()) == ["A", "B", "C", "D", "F"]
    assert new_arrivals(arrivals, None).count() == 5


def test_only_touched_partitions_are_rewritten(spark, tmp_dir):
    target, staging = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    rows = spark.createDataFrame([("A", 1, "old", 0), ("B", 1, "old", 1), ("C", 1, "old", 1)], "k string, ts int, v string, p int")
    rows.write.partitionBy("p").parquet(target)
    before = {f: os.path.getmtime(os.path.join(target, "p=0", f)) for f in os.listdir(os.path.join(target, "p=0"))}
    inc = spark.createDataFrame([("B", 2, "new", 1), ("D", 1, "new", 2), ("C", 0, "late", 1)], "k string, ts int, v string, p int")
    upsert_partitions(spark, target, inc, ["k"], "ts", "p", staging)
    out = {r["k"]: (r["v"], r["p"]) for r in spark.read.parquet(target).collect()}
    assert out == {"A": ("old", 0), "B": ("new", 1), "C": ("old", 1), "D": ("new", 2)}
    assert before == {f: os.path.getmtime(os.path.join(target, "p=0", f)) for f in os.listdir(os.path.join(target, "p=0"))}


def test_upsert_latest_is_idempotent(spark):
    target = spark.createDataFrame([("A", 1, "old"), ("B", 5, "old")], "k string, ts int, v string")
    inc = spark.createDataFrame([("A", 6, "new"), ("B", 4, "late"), ("C", 7, "new")], "k string, ts int, v string")
    out = {r["k"]: r["v"] for r in upsert_latest(target, inc, ["k"], "ts").collect()}
    assert out == {"A": "new", "B": "old", "C": "new"}
    again = upsert_latest(upsert_latest(target, inc, ["k"], "ts"), inc, ["k"], "ts")
    assert {r["k"]: r["v"] for r in again.collect()} == out


def test_observed_expectations(spark, tmp_dir):
    df = spark.range(0, 100)
    observed, obs = observe_violations(df, {"id_below_90": F.col("id") < 90})
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["id_below_90"] == 10


def test_upsert_keeps_untouched_rows_of_the_null_partition(spark, tmp_dir):
    target, staging = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    schema = "k string, ts int, p string"
    spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, "x")], schema).write.partitionBy("p").parquet(target)
    upsert_partitions(spark, target, spark.createDataFrame([("z", 1, None), ("b", 2, None)], schema), ["k"], "ts", "p", staging)
    out = sorted((r["k"], r["ts"], r["p"]) for r in spark.read.parquet(target).collect())
    assert out == [("a", 1, None), ("b", 2, None), ("c", 1, "x"), ("z", 1, None)]


SNAPSHOT = "k string, ts int, v string, p string"


def _rows(df):
    return sorted((r["k"], r["ts"], r["v"], r["p"]) for r in df.collect())


def test_snapshots_merge_over_several_increments(spark, tmp_dir):
    make = lambda rows: spark.createDataFrame(rows, SNAPSHOT)
    table = SnapshotTable(spark, os.path.join(tmp_dir, "t"), make([]).schema, ["k"], "ts", "p")
    assert table.read().count() == 0 and table.versions() == []
    assert table.merge(make([("a", 1, "one", None), ("b", 1, "one", "x y"), ("c", 1, "one", "1")])) == 1
    assert table.merge(make([("a", 2, "two", None), ("z", 1, "two", None), ("b", 0, "late", "x y")])) == 2
    assert table.merge(make([])) == 3
    assert table.merge(make([("d", 1, "four", ""), ("e", 1, "four", "01")])) == 4
    want = [("a", 2, "two", None), ("b", 1, "one", "x y"), ("c", 1, "one", "1"), ("z", 1, "two", None)]
    assert _rows(table.read(2)) == want and _rows(table.read(3)) == want
    assert _rows(table.read(1)) == [("a", 1, "one", None), ("b", 1, "one", "x y"), ("c", 1, "one", "1")]
    assert len(table.read().collect()) == 6 and {r[3] for r in _rows(table.read())} >= {"1", "01", "x y"}
    # Partitions that no increment touched are still the files of the first merge.
    first = table.manifest(1)
    assert table.manifest(4)["__part=1"] == first["__part=1"] and table.manifest(2)["__part=x y"] != first["__part=x y"]
    table.expire(keep=1)
    assert table.versions() == [4] and len(_rows(table.read())) == 6


def test_a_merge_that_fails_between_its_steps_changes_nothing(spark, tmp_dir, monkeypatch):
    make = lambda rows: spark.createDataFrame(rows, SNAPSHOT)
    table = SnapshotTable(spark, os.path.join(tmp_dir, "t"), make([]).schema, ["k"], "ts", "p")
    table.merge(make([("a", 1, "one", None), ("b", 1, "one", "x")]))
    before = _rows(table.read())

    def broken(*_):
        raise OSError("lost before the manifest is in place")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_commit", broken)
        with pytest.raises(OSError):
            table.merge(make([("a", 2, "two", None), ("c", 1, "two", "x")]))
    assert _rows(table.read()) == before and table.versions() == [1]
    # A merge that was planned on an old version fails instead of hiding the one that came between.
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "versions", lambda self: [])
        with pytest.raises(Conflict):
            table.merge(make([("c", 1, "two", "x")]))
    assert _rows(table.read()) == before
    assert table.merge(make([("a", 2, "two", None)])) == 2
    table.expire()
    assert _rows(table.read()) == [("a", 2, "two", None), ("b", 1, "one", "x")]
