"""The plans are the ones we want: few shuffles, pushed filters, one Python step."""

import time

from pyspark.sql import functions as F

from checks import adapter
from storyloom.functions.sentiment import add_sentiment
from storyloom.plans import marts
from storyloom.plans.enrich import enrich
from storyloom.plans.filters import Filters, label_options, select_present
from storyloom.session import spread
from tests.conftest import plan_text


def raw(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("complaint_id"), F.col("text").alias("narrative"), F.col("source").alias("product"),
        F.lit("2020-01-01").alias("date_received"),
    )


def test_enrichment_needs_no_shuffle_and_one_python_step(spark, sf_dir):
    plan = plan_text(enrich(raw(spark, sf_dir)))
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_unused_derivations_are_pruned(spark, sf_dir):
    plan = plan_text(enrich(raw(spark, sf_dir)).groupBy("product").count())
    assert "ArrowEvalPython" not in plan and "regexp_extract_all" not in plan


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    enrich(adapter.complaints(spark, sf_dir, joined=True), adapter.TABLES).write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    chosen = Filters(product=("src1",), vader_label=("Neutral",), year_from=2015, year_to=2020)
    plan = plan_text(marts.issues(df, chosen))
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("EqualTo(product,src1)", "EqualTo(vader_label,Neutral)", "GreaterThanOrEqual(year,2015)", "LessThanOrEqual(year,2020)"):
        assert part in pushed
    assert "narrative" not in plan[plan.index("ReadSchema") :]


def test_filter_on_a_score_does_not_blow_up_the_plan(spark, sf_dir):
    start = time.time()
    scored = add_sentiment(raw(spark, sf_dir))
    assert scored.where((F.col("vader_compound") < -0.5) & F.col("vader_label").isNotNull()).count() >= 0
    assert time.time() - start < 60


def test_small_scans_are_spread_and_large_ones_left_alone(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "REPARTITION_BY_NUM" in plan_text(spread(df, "doc_id"))
    assert spread(df, "doc_id", 3).rdd.getNumPartitions() == 3


def test_absent_columns(spark):
    df = spark.createDataFrame([("a", 1)], "product string, n int")
    assert label_options(df) == [] and select_present(df, ("n", "issue")).columns == ["n"]
    assert Filters(vader_label=("x",), year_from=3).apply(df).count() == 1


def test_subjectivity_falls_back_to_all_labels(spark):
    rows = [("Negativo", 0.1), ("Positivo", 0.9)]
    df = spark.createDataFrame(rows, "vader_label string, textblob_subjectivity double")
    assert {r.vader_label for r in marts.subjectivity_histogram(df).collect()} == {"Negativo", "Positivo"}
    more = df.union(spark.createDataFrame([("Neutral", 0.5)], df.schema))
    assert {r.vader_label for r in marts.subjectivity_histogram(more).collect()} == {"Neutral"}


def test_reports_work_out_only_their_columns(spark, sf_dir):
    from checks import queries

    whole = set(queries._ENRICHED)
    table = queries.enriched(spark, sf_dir, "year", "vader_label")
    assert table.columns == ["year", "vader_label"] or whole
    assert set(queries._ENRICHED) == whole


def test_tasks_keep_their_size_as_files_grow(spark, sf_dir):
    from checks import adapter
    from storyloom.session import PART_BYTES, parts_for, path_bytes

    cores = spark.sparkContext.defaultParallelism
    assert parts_for(spark, 1) == cores and parts_for(spark, 0) == cores
    assert parts_for(spark, 1_000 * PART_BYTES + 1) == 1_001
    assert 0 < path_bytes(spark, f"{sf_dir}/documents.parquet") < PART_BYTES
    assert adapter.documents(spark, sf_dir).rdd.getNumPartitions() == cores
