"""Cells counted where they are read: what a profile says of them, and the bounds of its summaries."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.functions import number_in
from starloom.operators import cells as C
from starloom.operators import profile as L

ODD = ["0", "-0", "0.0", "-0.00", "+0", "00", "1", "-1", "+1", "-10", "10", "-01.50", " -2.5 ", ".0", "-.5", "5.", ".", "-", "+", "1e3", "0e5", "-0e1", "-1E-3", "5e", "e5",
       "1e-400", "-1e-400", "1e400", "0x1p3", "1x1p3", "-0x1p-2", "0x", "9x9p9", "1d", "0d", "2F", "-0f", "inf", "-Infinity", "inf1", "nan", "NaN", "nan2", "\t-7\n", "\x000", "-3 ",
       "0." + "0" * 330 + "1", "-0." + "0" * 330 + "1", "-0." + "0" * 280 + "1", "9" * 400, "-" + "9" * 320, "1,5", "-0,0", "a,b", ",", "", " ", "   ", "\t", "x", "X", "ABC", "Ção 12", "ÇÃO 34",
       "straße 1", "ŉ", "٣", "1_0", "2024-01-01", "2023-12-31", "12 Elm", "0E0x", "O'Brien", "a|b", "5 ", "0 ", "\U0001F600 1", None]


def cell_by_cell(values):
    """The profile's numbers by the expressions themselves."""
    v, num = F.col("value"), number_in("value")
    return values.agg(F.count(F.lit(1)), F.count_if(v.isNull()), F.count_if(F.trim(v) == ""), F.count_if(F.upper(v) != v), F.count(num),
                      F.count_if(v.contains(",")), F.count_if(num < 0), F.count_if(num == 0), F.min(F.length(v)), F.max(F.length(v))).first()


def test_profile_of_odd_texts_equals_cell_by_cell(spark):
    df = spark.createDataFrame([(x, [x, x]) for x in ODD * 3 + ["-12.5"] * 7], "a string, t array<string>").repartition(3)
    got = {r["column_name"]: tuple(r)[2:12] for r in L.column_profile({"p": df}).collect()}
    assert got == {"a": tuple(cell_by_cell(df.select(F.col("a").alias("value")))),
                   "t": tuple(cell_by_cell(df.select(F.array_join("t", "|").alias("value"))))}
    # Each by itself too: in sums of many, errors may make up for each other.
    each = spark.createDataFrame([ODD], ", ".join(f"c{k:02d} string" for k in range(len(ODD))))
    for r in L.column_profile({"p": each}).collect():
        assert tuple(r)[2:12] == tuple(cell_by_cell(each.select(F.col(r["column_name"]).alias("value")))), ODD[int(r["column_name"][1:])]


def test_profile_of_no_rows_and_of_nulls(spark):
    empty = spark.createDataFrame([], "a string")
    nulls = spark.createDataFrame([(None, "x")] * 5, "a string, b string")
    tables = {"empty": empty, "nulls": nulls}
    got = L.column_profile(tables)
    assert {(r["table_name"], r["column_name"], r["n_rows"], r["n_null"], r["shortest"]) for r in got.collect()} == {("nulls", "a", 5, 5, None), ("nulls", "b", 5, 0, 1)}
    assert {tuple(r)[1:] for r in L.frequent_values(tables, got).collect()} == {("a", k, None, 5) for k in ("value", "shape")} | {("b", k, "x", 5) for k in ("value", "shape")}


def test_cells_are_not_made_rows(spark, tmp_dir):
    # each cell was a row of its own, whose text went through two sketches and then once more through a join.
    df = spark.range(3000).select((F.col("id") % 7).cast("string").alias("a"), F.col("id").cast("string").alias("b"))
    profile = L.column_profile({"t": df})
    assert "explode" not in (plan := profile._jdf.queryExecution().optimizedPlan().toString()) and "inline" not in plan
    profile.write.parquet(f"{tmp_dir}/profile")
    stored = spark.read.parquet(f"{tmp_dir}/profile")
    # What the profile has counted exactly is not counted again: the table isn't read.
    unread = df.withColumn("a", F.raise_error(F.lit("read again")).cast("string"))
    got = {(r["column_name"], r["kind"], r["value"]): r["n"] for r in L.frequent_values({"t": unread}, stored).collect()}
    assert got == {("a", "value", str(k)): 429 if k < 4 else 428 for k in range(7)} | {("a", "shape", "9"): 3000} | {
        ("b", "shape", "99"): 90, ("b", "shape", "999"): 900, ("b", "shape", "9999"): 2000}


@pytest.mark.parametrize("tracked, handed_on", [(10_000, 1_000), (400, 300), (250, 220)])
def test_values_that_tasks_lose_are_counted_again(spark, tmp_dir, monkeypatch, tracked, handed_on):
    monkeypatch.setattr(L, "TRACKED", tracked)
    monkeypatch.setattr(L, "HANDED_ON", handed_on)
    draw = random.Random(1)
    # Four unlike parts: a value in one only, one that comes late, one just at the share and one just below, the rest told apart by nothing but themselves.
    rows = [("one" if k < 3000 and k % 4 == 0 else "late" if k > 11_000 and k % 9 == 0 else "at" if k % 75 == 1 else "below" if k % 100 == 53 and k > 200 else f"v{draw.randrange(10**9)}",
             draw.choice(["x", "y"]) + "".join(draw.choice("abcdefgh") for _ in range(draw.choice([1, 9])))) for k in range(12_000)]
    spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "a string, w string").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    L.column_profile({"t": df}).write.parquet(f"{tmp_dir}/profile")
    stored = spark.read.parquet(f"{tmp_dir}/profile")
    known = {(r["column_name"], kind, x["item"]): (x["count"], x["missed"]) for r in stored.collect() for kind in ("value", "shape") for x in r[f"{kind}s"]}
    want = Counter()
    for a, w in rows:
        for column, v in (("a", a), ("w", w)):
            want[column, "value", v] += 1
            want[column, "shape", "".join("9" if x.isdigit() else x for x in v)] += 1
    assert all(n <= want[key] <= n + missed for key, (n, missed) in known.items())
    assert any(missed for _, missed in known.values())
    # The second pass makes no texts of columns that it needn't count.
    more = df.withColumn("z", F.raise_error(F.lit("read again")).cast("string"))
    got = {(r["column_name"], r["kind"], r["value"]): r["n"] for r in L.frequent_values({"t": more}, stored).collect()}
    assert got == {key: n for key, n in want.items() if n >= 120} and ("a", "value", "at") in got and ("a", "value", "one") in got


def test_summaries_stay_within_their_bounds():
    draw = np.random.default_rng(2)
    for most in (5, 50, 1000):
        found, true = C.Frequent(most), Counter()
        for _ in range(40):
            texts = [str(int(x)) for x in draw.zipf(draw.choice([1.1, 1.5]), 400) + draw.integers(0, 3)]
            counts = Counter(texts)
            true.update(counts)
            found.add(pa.array([x.encode() for x in counts]), np.array([*counts.values()]))
            held = {v.decode(): (s, m) for v, s, m in zip(found.values.to_pylist(), found.seen, found.missed)}
            assert len(held) == len(found.values) <= most and found.lost <= sum(true.values()) / most
            assert all(held[v][0] <= n <= sum(held[v]) if v in held else n <= found.lost for v, n in true.items())


def test_chunks_of_a_task_are_summed_up(monkeypatch):
    monkeypatch.setattr(C, "CHUNK_ROWS", 300)
    draw, total, texts = random.Random(3), Counter(), Counter()
    for task in range(3):
        values = [None if draw.random() < 0.1 else "often" if draw.random() < 0.1 else f"v{draw.randrange(10**6)}" for _ in range(2000)]
        texts.update(values)
        batches = [pa.RecordBatch.from_pydict({"a": pa.array(values[k:k + 70], pa.string())}) for k in range(0, 2000, 70)]
        assert len([*C.chunks(batches)]) == 6
        for out in C.summaries(50, 20)(iter(batches)):
            for r in out.to_pylist():
                total["n", r["kind"], r["text"]] += r["n"]
                total["missed", r["kind"], r["text"]] += r["missed"]
    assert sum(n for (what, kind, _), n in total.items() if (what, kind) == ("n", "cell")) == 6000
    assert total["n", "cell", None] == texts[None] and total["n", "cell", "often"] == texts["often"]
    lost = total["missed", "value", None]
    assert 0 < lost <= 6000 / 50 + 6000 / 20
    for text, n in texts.items():
        if text is not None:
            assert total["n", "value", text] <= n <= total["n", "value", text] + total["missed", "value", text] + lost
    assert total["n", "value", "often"] == texts["often"] and total["missed", "value", "often"] == -lost
