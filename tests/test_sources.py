import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import adapter
from storyloom import session
from storyloom.plans.enrich import STAGES, enrich, run_stages
from storyloom.sources import files, schema
from storyloom.streaming.incremental import enrich_new_files

CSV = (
    'a,b,c\n1,"line one\nline two",x\n2,"say ""hi"", ok",y\n3,short\n4,too,many,fields\n'
    '5,"a ""quoted, comma"" and, more",z\n6,plain,w\n7,"never closed,v\n'
)


def three_strings():
    return T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def test_damaged_csv_rows(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    got = sorted(tuple(r) for r in files.read_csv_skip_bad(spark, str(path), three_strings()).collect())
    assert got == [
        ("1", "line one\nline two", "x"), ("2", 'say "hi", ok', "y"), ("3", "short", None),
        ("5", 'a "quoted, comma" and, more', "z"), ("6", "plain", "w"),
    ]


def test_damaged_row_with_a_very_long_field(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text('a,b,c\n1,"' + "word, " * 60_000 + '",x,extra\n2,"' + "w," * 50_000 + '",y\n')
    got = files.read_csv_skip_bad(spark, str(path), three_strings()).select("a", F.length("b")).collect()
    assert [tuple(r) for r in got] == [("2", 100_000)]


def test_stage_files(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert files.load_stage(spark, path) is None
    assert files.save_stage(spark.range(7), path) == {"path": path, "rows": 7, "columns": 1}
    assert files.load_stage(spark, path).count() == 7
    os.remove(f"{path}/_SUCCESS")
    assert files.load_stage(spark, path) is None


def test_missing_table_is_empty_with_its_schema(spark, tmp_path):
    df = files.read_enriched(spark, str(tmp_path / "none"), schema.enriched_schema())
    assert df.count() == 0 and df.schema["entities"].dataType == T.MapType(T.StringType(), T.ArrayType(T.StringType()))
    assert len(df.columns) == 43


def test_source_headers(spark):
    row = tuple(str(i) for i in range(len(schema.SOURCE_COLUMNS)))
    df = schema.rename_source(spark.createDataFrame([row], schema.SOURCE_SCHEMA).withColumn("other", F.lit(1)))
    assert df.columns == [*schema.SOURCE_COLUMNS.values(), "other"]
    done = enrich(df.withColumn("narrative", F.lit("Equifax ignored my dispute and lied again")).withColumn("date_received", F.lit("2020-01-02")))
    wanted = schema.enriched_schema()
    assert {f.name: f.dataType.simpleString() for f in done.schema if f.name in wanted.names} == {
        f.name: f.dataType.simpleString() for f in wanted
    }


def test_csv_export_writes_json_for_nested_columns(spark, tmp_path):
    df = spark.sql("SELECT 1 AS i, map('ORG', array('A, \"B\"')) AS e, array('x', 'y') AS t")
    files.export_csv(df, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, escape='"').first()
    assert (back.i, back.e, back.t) == ("1", '{"ORG":["A, \\"B\\""]}', '["x","y"]')


def test_resume_computes_only_what_is_missing(spark, sf_dir, tmp_path):
    folder = str(tmp_path)
    rows = adapter.complaints(spark, sf_dir)
    first, reports = run_stages(spark, rows, folder, adapter.TABLES)
    assert [r["path"].split("/")[-1] for r in reports] == list(STAGES)
    direct = enrich(rows, adapter.TABLES)
    columns = sorted(c for c in direct.columns if c != "entities")
    assert sorted(map(str, first.select(columns).collect())) == sorted(map(str, direct.select(columns).collect()))
    _, again = run_stages(spark, None, folder, adapter.TABLES)
    assert again == []
    os.remove(f"{folder}/04_sentiment/_SUCCESS")
    _, rest = run_stages(spark, None, folder, adapter.TABLES)
    assert [r["path"].split("/")[-1] for r in rest] == ["04_sentiment", "05_features"]
    with pytest.raises(ValueError):
        run_stages(spark, None, str(tmp_path / "empty"), adapter.TABLES)


def test_first_rows_only_when_asked(spark, sf_dir, tmp_path):
    last, _ = run_stages(
        spark, adapter.complaints(spark, sf_dir), str(tmp_path), adapter.TABLES, key="complaint_id", sample=5
    )
    assert last.count() == 5


def test_incremental_runs_equal_one_batch_run(spark, sf_dir, tmp_path):
    source, sink, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    rows = adapter.complaints(spark, sf_dir)
    counts = []
    for part in ("complaint_id % 3 = 0", None, "complaint_id % 3 > 0"):
        if part:
            rows.where(part).write.mode("append").parquet(source)
        enrich_new_files(spark, source, rows.schema, sink, progress, adapter.TABLES, files_per_batch=1)
        counts.append(spark.read.parquet(sink).count())
    batch = enrich(rows, adapter.TABLES)
    assert counts[0] == counts[1] < counts[2] == batch.count()
    columns = ["complaint_id", "processed_text", "vader_compound", "entity_count"]
    got, want = (sorted(map(str, d.select(columns).collect())) for d in (spark.read.parquet(sink), batch))
    assert got == want


def test_scratch_folder_follows_the_session(spark):
    base = session.scratch_dir(spark, "x").rsplit("/", 1)[0]
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == base
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_valence_file(spark, tmp_path):
    from storyloom.functions.sentiment import add_sentiment
    from storyloom.sources import term_files

    path = tmp_path / "lexicon.txt"
    path.write_text("Splendid\t2.5\t0.5\t[3, 2]\ndreadful\t-2.0\t0.4\t[-2]\n:(\t-1.9\t0.3\t[-2]\n\"\t\t\t\n")
    lex = term_files.with_valence_file(spark, str(path))
    assert lex.valence == {"splendid": 2.5, "dreadful": -2.0, ":(": -1.9} and lex.negations
    df = spark.createDataFrame([("splendid work",), ("good dreadful :(",)], "narrative string")
    got = [r.vader_compound for r in add_sentiment(df, lex=lex).collect()]
    assert got == [round(2.5 / (2.5**2 + 15) ** 0.5, 4), round(-3.9 / (3.9**2 + 15) ** 0.5, 4)]
    with pytest.raises(ValueError):
        term_files.as_dict(spark.range(5).withColumn("v", F.lit(1)), "id", "v", limit=4)


def test_valence_file_capitals_and_conflicts(spark, tmp_path):
    from storyloom.sources import term_files

    path = tmp_path / "lexicon.txt"
    path.write_text(":D\t2.3\t0.5\t[2]\nXD\t2.7\t0.5\t[3]\nxd\t2.8\t0.5\t[3]\nxd\t2.8\t0.6\t[3]\n")
    assert [tuple(r) for r in term_files.read_valence_file(spark, str(path)).collect()] == [("xd", 2.8)]
    path.write_text("fine\t0.8\t0.5\t[1]\nFine\t0.9\t0.5\t[1]\n")
    with pytest.raises(Exception, match="two valences for fine"):
        term_files.read_valence_file(spark, str(path)).collect()


def test_stage_files_are_packed(spark, tmp_path):
    from storyloom.sources import files as f

    f.save_stage(spark.range(10), str(tmp_path / "s"))
    assert list((tmp_path / "s").glob("*.zstd.parquet")) and f.load_stage(spark, str(tmp_path / "s")).count() == 10
