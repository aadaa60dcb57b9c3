import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storyloom.operators import joins, profile, quality, quantiles, sampling, topk
from storyloom.operators.histogram import histogram
from tests.conftest import plan_text


# Quantiles -----------------------------------------------------------------

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.98, 1.0]


@pytest.mark.parametrize("kind", ["uniform", "hot", "heavy_tail", "constant", "single", "two"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(-5, 5, 3001),
        # a third of the rows hold one value
        "hot": np.where(rng.random(3000) < 0.34, 7.0, rng.integers(0, 50, 3000).astype(float)),
        # nearly all values fall in one of the equal ranges
        "heavy_tail": np.append(rng.normal(0, 1, 2000), [1e9, 1e9]),
        "constant": np.full(10, 4.0), "single": np.array([2.5]), "two": np.array([1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    long = quantiles.measures_long(df, {"x": F.col("x"), "neg": -F.col("x")})
    got = {(r.group, r.q): r.value for r in quantiles.exact_quantiles(long, ["x", "neg"], QS).collect()}
    assert len(got) == 2 * len(QS)
    for q in QS:
        assert got["x", q] == pytest.approx(np.quantile(values, q), rel=1e-9)
        assert got["neg", q] == pytest.approx(np.quantile(-values, q), rel=1e-9)


def test_describe_matches_pandas(spark):
    frame = pd.DataFrame({"a": [1.0, 2.0, 2.0, 9.0, None], "b": [5.0, 5.0, 5.0, 5.0, 5.0]})
    df = spark.createDataFrame(frame).replace(float("nan"), None)
    got = {r.measure: r for r in profile.describe(df, {c: F.col(c) for c in "ab"}).collect()}
    for c in "ab":
        want = frame[c].describe()
        r = got[c]
        assert (r["count"], r.mean, r.std, r.min, r.q25, r.median, r.q75, r.max) == pytest.approx(tuple(want))


def test_an_outlier_leaves_the_ranges_even(spark):
    values = spark.range(200_000).selectExpr("'x' AS `group`", "id / 7.0D AS v", "1L AS c")
    outlier = values.limit(1).withColumn("v", F.lit(1e12))
    ranges = quantiles.value_ranges(values.union(outlier)).collect()
    assert sum(r.c for r in ranges) == 200_001
    assert max(r.c for r in ranges) < 2_000
    ends = sorted((r["first"], r["last"]) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert spark.range(1).select(quantiles.one_quantile(df, F.col("x"), 0.5)).first()[0] is None


# Sampling ------------------------------------------------------------------


def test_samples_are_exact_and_repeatable(spark):
    # half of the rows are in one group
    df = spark.range(4000).withColumn("g", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)))
    df = df.withColumn("g", F.when(F.col("id") % 50 == 1, None).otherwise(F.col("g")))
    order = {r.id: r.h for r in df.select("id", sampling.sample_rank("id").alias("h")).collect()}
    for n in (1, 40, 4000, 9000):
        got = {r.id for r in sampling.sample_uniform(df, "id", n).collect()}
        assert got == set(sorted(order, key=lambda i: order[i])[:n])
    rows = df.collect()
    for n in (3, 500, 5000):
        got = sorted((r.g, r.id) for r in sampling.sample_by_group(df, "g", "id", n).collect())
        want = []
        for g in {r.g for r in rows} - {None}:
            members = sorted((r.id for r in rows if r.g == g), key=lambda i: order[i])
            want += [(g, i) for i in members[:n]]
        assert got == sorted(want)
    again = sampling.sample_uniform(df.repartition(5), "id", 40).collect()
    assert {r.id for r in again} == {r.id for r in sampling.sample_uniform(df, "id", 40).collect()}


def test_uniform_sample_of_an_empty_table(spark):
    assert sampling.sample_uniform(spark.range(0), "id", 5).count() == 0


def test_first_rows(spark):
    df = spark.range(30)
    assert [r.id for r in sampling.first_rows(df, "id", 3).collect()] == [0, 1, 2]
    assert sampling.first_rows(df, "id", None).count() == 30


# Joins ---------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_same_rows_beyond_the_broadcast_limit(spark, how):
    df = spark.range(2000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 11).cast("string")))
    table = spark.createDataFrame([("hot", 1), ("4", 2), ("5", 3), ("absent", 4)], "k string, v int")
    small = joins.lookup_join(df, table, "k", how)
    assert "BroadcastHashJoin" in plan_text(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup_join(df, table, "k", how, most_bytes=2)
        assert "Broadcast" not in plan_text(large)
        key = lambda r: (r.id, str(r))
        assert sorted((r.asDict() for r in large.collect()), key=str) == sorted((r.asDict() for r in small.select(large.columns).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        joins.lookup_join(df, table, "k", "full")


# Counts, profiles, histograms ----------------------------------------------


def test_top_k_ties_nulls_and_subset(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "b", "a", "a", "c", None, None, None]], "x string")
    assert [tuple(r) for r in topk.top_k(df, "x", 2).collect()] == [("a", 2), ("b", 2)]
    assert topk.keep_top(df, "x", 2).count() == 4
    assert "BroadcastHashJoin" in plan_text(topk.keep_top(df, "x", 2))


def test_histogram_keeps_every_row(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.1, 0.5, 0.999, 1.0, 3.0, None)], "x double")
    got = {r.bin: r.n for r in histogram(df, F.col("x"), 0, 1, 10).collect()}
    assert sum(got.values()) == 7 and got[10] == 3 and got[1] == 2 and got[2] == 1 and got[6] == 1


def test_correlation_of_a_constant_is_null(spark):
    frame = pd.DataFrame({"a": [1.0, 2.0, 4.0], "b": [3.0, 1.0, 0.5], "c": [1.0, 1.0, 1.0]})
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(spark.createDataFrame(frame), ["a", "b", "c", "gone"]).collect()}
    assert got["a", "b"] == pytest.approx(frame.corr().loc["a", "b"])
    assert got["a", "c"] is None and got["b", "c"] is None and len(got) == 3


def test_duplicates_nulls_and_schema(spark):
    rows = [(1, {"a": "x"}), (1, {"a": "x"}), (1, None), (1, None), (None, None), (2, {})]
    df = spark.createDataFrame(rows, "n int, m map<string,string>")
    assert profile.duplicate_rows(df).first()[:] == (6, 2)
    assert {r.column: r.nulls for r in profile.null_profile(df).collect()} == {"n": 1, "m": 3}
    assert [tuple(r) for r in profile.schema_listing(df).orderBy("position").collect()] == [
        (0, "n", "int", 6), (1, "m", "map<string,string>", 6),
    ]
    assert profile.duplicate_rows(df.limit(0)).first()[:] == (0, 0)
    times = spark.sql("SELECT timestamp'2020-01-01 00:00:00.000001' AS t UNION ALL SELECT timestamp'2020-01-01 00:00:00.000002'")
    assert profile.duplicate_rows(times).first()[:] == (2, 0)


# Text quality --------------------------------------------------------------


def test_text_column_choice(spark):
    df = spark.createDataFrame([("ab", "abcdef", 1), ("abc", None, 2)], "a string, b string, n int")
    assert quality.detect_text_column(df) == "b"
    assert quality.detect_text_column(df.withColumnRenamed("a", "texto")) == "texto"
    with pytest.raises(ValueError):
        quality.detect_text_column(df.select("n"))


def test_corrections(spark):
    df = spark.createDataFrame([("The the the  cat , sat sat!!",), (" ",), (None,), ("fine",)], "t string")
    got = [tuple(r) for r in quality.correct_texts(df, "t").select("texto_corregido", "cantidad_errores", "tipos_errores").collect()]
    assert got == [
        ("The the cat, sat!", 5, ["doubled_word", "doubled_word", "doubled_space", "space_before_comma", "repeated_mark"]),
        (" ", 0, []),
        ("fine", 0, []),
    ]


def test_samples_and_first_rows_stay_in_place(spark):
    df = spark.range(0, 300_000, 1, 6).withColumn("s", F.concat(F.lit("k"), F.col("id") % 7))
    for taken in (sampling.sample_uniform(df, "id", 250_000), sampling.first_rows(df, "id", 250_000)):
        assert "Sort" not in plan_text(taken) and "Exchange" not in plan_text(taken)
        assert taken.count() == 250_000
    assert sampling.first_rows(df, "id", 250_000).agg(F.max("id")).first()[0] == 249_999


def test_first_rows_of_repeated_null_and_negative_keys(spark):
    rows = [(k, i) for i, k in enumerate([5, None, -3, 5, 0, None, 5, -3])]
    df = spark.createDataFrame(rows, "k int, i int")
    keys = lambda n: sorted((r.k for r in sampling.first_rows(df, "k", n).collect()), key=lambda k: (k is None, k or 0))
    order = [-3, -3, 0, 5, 5, 5, None, None]
    assert [keys(n) for n in range(9)] == [order[:n] for n in range(9)]
    words = df.select(F.col("k").cast("string").alias("k"), "i")
    assert sorted(r.k for r in sampling.first_rows(words, "k", 4).collect()) == ["-3", "-3", "0", "5"]
    halves = df.select((F.col("k") / 2).alias("k"), "i")
    assert [r.k for r in sampling.first_rows(halves, "k", 3).collect()] == [-1.5, -1.5, 0.0]
    assert sampling.sample_uniform(df, "k", 7).count() == 7
    assert set(sampling.sample_uniform(df, "k", 4).collect()) == set(sampling.sample_uniform(df.repartition(3), "k", 4).collect())


def test_a_long_border_takes_more_digits(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BORDER", 3)
    monkeypatch.setattr(sampling, "PREFIX", 1)
    df = spark.range(500).select((F.col("id") * 37 % 100 - 50).alias("k"), "id")
    want = sorted(r.k for r in df.collect())
    for n in (1, 5, 6, 123, 499):
        assert sorted(r.k for r in sampling.first_rows(df, "k", n).collect()) == want[:n]


def test_correlation_with_scattered_nulls_and_large_close_numbers(spark):
    draw = np.random.default_rng(3)
    frame = pd.DataFrame({"a": 1.7e9 + draw.normal(size=400), "b": draw.normal(size=400), "c": 0.1, "d": np.nan})
    frame["b"] += frame["a"] - 1.7e9
    frame.loc[draw.random(400) < 0.3, "a"] = np.nan
    frame.loc[draw.random(400) < 0.2, "b"] = np.nan
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(df, "abcd").collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert abs(got["a", "b"] - frame["a"].corr(frame["b"])) < 1e-7
    assert got["a", "c"] is None and got["b", "c"] is None
