"""Suites and profiles in one pass over each table, writes that set rows
aside, layouts for joins, dates picked by shape."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.functions import dates as D
from starloom.functions import vocab
from starloom.operators import profile as L
from starloom.operators.expectations import REASONS, Expectation, evaluate, read_kept, read_quarantined, write_checked
from starloom.operators.suite import Suite, bad_rows, distinct_keys
from starloom.plans import q_sources
from starloom.plans.catalog import queries
from starloom.sources import layers as B

SF = "/root/testdata/sf0.001"


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_a_suite_scans_each_table_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, None, "y"), (2, None, "y")], "k int, v string, w string").write.parquet(path)
    df = spark.read.parquet(path)
    dim = spark.createDataFrame([("a",), ("b",)], "v string")
    suite = Suite({"t": df, "u": df})
    suite.unique("grain", "t", ["k", "v"])
    suite.unique("grain_k", "t", ["k"])
    suite.no_rows("w_given", "t", F.col("w").isNull())
    suite.vocabulary("w_words", "t", "w", ["x"])
    suite.references("v_known", "t", "v", dim, "v")
    suite.same_count("as_many", "u", suite.measure("t", "keys", distinct_keys("k", "v")))
    suite.check("twice", "t", lambda a, b: a * 2 + b, suite.measure("t", "bad", bad_rows(F.col("w") == "y")), suite.measure("u", "none", bad_rows(F.lit(False))))
    out = suite.run()
    assert {r["check_name"]: (r["violations"], r["passed"]) for r in out.collect()} == {
        "grain": (1, False), "grain_k": (2, False), "w_given": (1, False), "w_words": (2, False), "v_known": (2, False),
        "as_many": (1, False), "twice": (4, False)}
    assert scans(out) == 2  # t and u


def test_registered_suites_scan_each_table_once(spark):
    qs = queries()
    assert scans(qs["v05_unique_grain"](spark, SF)) == 3
    assert scans(qs["v06_closed_vocabulary"](spark, SF)) == 2
    # Nine silver tables and the nine sources behind them, one of which (regions) reads its table twice.
    assert scans(qs["v01_row_counts"](spark, SF)) == 19


def test_suite_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v string")
    out = evaluate([Expectation("u", "t", "unique", {"columns": ["k"]}), Expectation("n", "t", "not_null", {"column": "v"}),
                    Expectation("w", "t", "vocabulary", {"column": "v", "allowed": ["a"]})], {"t": empty})
    assert {(r["violations"], r["passed"]) for r in out.collect()} == {(0, True)}
    with pytest.raises(ValueError):
        evaluate([Expectation("x", "t", "no_such_kind")], {"t": empty})


def test_write_sets_failing_rows_aside(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None), (-1, None), (None, "b")], "n int, s string")
    counts = write_checked(df, f"{tmp_dir}/out", {"positive": F.col("n") > 0, "named": F.col("s").isNotNull()})
    assert counts == {"kept": 1, "quarantined": 3, "failed:positive": 2, "failed:named": 2}
    assert [tuple(r) for r in read_kept(spark, f"{tmp_dir}/out").collect()] == [(1, "a")]
    aside = {(r["n"], r["s"]): r[REASONS] for r in read_quarantined(spark, f"{tmp_dir}/out").collect()}
    assert aside == {(2, None): ["named"], (-1, None): ["positive", "named"], (None, "b"): ["positive"]}


def test_profile_in_one_pass_finds_every_frequent_value(spark, tmp_dir):
    rows = [(str(k % 7) if k % 3 else f"u{k}", None if k % 5 == 0 else f"2024-01-{k % 28 + 1:02d}", ["x", "y"]) for k in range(3000)]
    spark.createDataFrame(rows, "a string, d string, t array<string>").withColumn("n", F.struct(F.col("a").alias("b"))).write.parquet(f"{tmp_dir}/p")
    df = spark.read.parquet(f"{tmp_dir}/p")
    profile = L.column_profile({"p": df})
    assert scans(profile) == 1
    by = {r["column_name"]: r for r in profile.collect()}
    assert set(by) == {"a", "d", "t", "n_b"} and by["d"]["n_null"] == 600 and by["a"]["n_numeric"] == 2000 and by["t"]["longest"] == 3
    got = {(r["column_name"], r["kind"], r["value"]): r["n"] for r in L.frequent_values({"p": df}, profile).collect()}
    cells = {"a": [r[0] for r in rows], "d": [r[1] for r in rows], "t": ["x|y"] * 3000}
    cells["n_b"] = cells["a"]
    want = {}
    for c, values in cells.items():
        for kind, of in (("value", lambda v: v), ("shape", lambda v: v and "".join("9" if x.isdigit() else x for x in v))):
            for v in values:
                want[c, kind, of(v)] = want.get((c, kind, of(v)), 0) + 1
    assert got == {k: n for k, n in want.items() if n >= 30}


def test_bucketed_facts_join_without_an_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = q_sources._bucketed(spark, SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join and join.count("Bucketed: true") == 2


def test_malformed_records_make_no_silver_rows(spark, tmp_dir):
    with open(f"{tmp_dir}/tickets.ndjson", "w") as f:
        f.write('{"ticket_id": "T1", "status": "open"}\n{"ticket_id": "T2", \nnot json\n')
    B.build_bronze_from_files(spark, tmp_dir, f"{tmp_dir}/out", only=["tickets"])
    kept = B.set_aside_malformed(spark, f"{tmp_dir}/out", "tickets")
    assert [r["ticket_id"] for r in kept.collect()] == ["T1"]
    aside = B.read_table(spark, f"{tmp_dir}/out", "quarantine", "tickets").collect()
    assert sorted(r["_corrupt_record"] for r in aside) == ['not json', '{"ticket_id": "T2", '] and all(r["_source_file"] for r in aside)


def test_dates_picked_by_shape_equal_layouts_tried_one_by_one(spark):
    draw = random.Random(4)
    forms = ["2025-01-02T03:04:05", "2025-01-02 03:04:05", "02/01/2025 03:04", "2025-01-02", "02/01/2025", "2025/01/02"]
    texts = [None, "", " ", "2025-13-40", "31/02/2025 10:00", "0000-01-01", "2024-02-29", "2023-02-29", "2025-01-02 23:59:60", "2025-01-02 24:00:00"]
    for _ in range(4000):
        t = "".join(str(draw.randrange(10)) if c.isdigit() and draw.random() < 0.3 else c for c in draw.choice(forms))
        texts.append(draw.choice(["", " "]) + t + draw.choice(["", "", "", "x", "0", " "]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    one_by_one = F.coalesce(*[D.parse_strict(F.trim("t"), f) for f in vocab.DATETIME_FORMATS])
    both = df.select("t", one_by_one.cast("string").alias("a"), D.parse_multi_format_timestamp("t").cast("string").alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty() and both.where("b IS NOT NULL").count() > 1000
    # Two layouts of one shape: the first that fits; a layout of other fields: one by one.
    two = D.parse_multi_format_timestamp("t", ["dd/MM/yyyy", "MM/dd/yyyy"])
    got = [r[0] and str(r[0])[:10] for r in spark.createDataFrame([("31/12/2024",), ("12/31/2024",), ("01/02/2024",)], "t string").select(two).collect()]
    assert got == ["2024-12-31", "2024-12-31", "2024-02-01"]
    assert D.layout_fields("yyyy-MM-dd EEE") is None and D.layout_fields("HH:mm") is None
    assert D.layout_fields("yyyy-MM-dd'T'HH:mm") == ("9999-99-99T99:99", {"yyyy": 1, "MM": 6, "dd": 9, "HH": 12, "mm": 15})
