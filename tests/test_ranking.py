import random

import pytest
from pyspark.sql import functions as F

from sessionloom.functions.sampling import hash_key
from sessionloom.operators.ranking import range_splits, rank_by_hash, running_sums, sample_rows


def test_rank_equals_global_sort(spark):
    df = spark.range(500).withColumn("k", hash_key("t", F.col("id")))
    ranked = {r["id"]: r["rank"] for r in rank_by_hash(df, "k").collect()}
    order = [r["id"] for r in df.orderBy("k").collect()]
    assert [ranked[i] for i in order] == list(range(1, 501))


def test_rank_per_group_and_first(spark):
    df = spark.range(300).select("id", (F.col("id") % 2).alias("g"), hash_key("t", F.col("id")).alias("k"))
    ranked = rank_by_hash(df, "k", by=["g"], first=10).collect()
    for g in (0, 1):
        want = [r["id"] for r in df.where(F.col("g") == g).orderBy("k").limit(10).collect()]
        got = [r["id"] for r in sorted((r for r in ranked if r["g"] == g), key=lambda r: r["rank"])]
        assert got == want


@pytest.mark.parametrize("n", [0, 1, 37, 200, 999])
def test_sample_size_is_exact(spark, n):
    df = spark.range(200)
    rows = [r[0] for r in sample_rows(df, n, "id").collect()]
    assert len(rows) == min(n, 200) and len(set(rows)) == len(rows)
    assert set(rows) == {r[0] for r in sample_rows(df.repartition(9), n, "id").collect()}


def test_full_sort_never_happens_in_one_task(spark):
    df = spark.range(100).withColumn("k", hash_key(F.col("id")))
    text = rank_by_hash(df, "k", first=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in text and "Sort [k" not in text


@pytest.mark.parametrize("pieces", [1, 2, 16])
def test_running_sums_equal_brute_force(spark, pieces):
    rng = random.Random(5)
    values = sorted({round(rng.random() ** 3, 5) for _ in range(400)})
    rows = [(v, rng.randint(0, 5), rng.randint(0, 5)) for v in values]
    df = spark.createDataFrame(rows, "p double, a long, b long").repartition(5)
    splits = range_splits(df, "p", pieces)
    assert len(splits) == pieces - 1
    got = {r["p"]: (r["sa"], r["sb"]) for r in running_sums(df, "p", {"sa": "a", "sb": "b"}, splits).collect()}
    for p, _, _ in rows:
        assert got[p] == (sum(a for q, a, _ in rows if q >= p), sum(b for q, _, b in rows if q >= p))
