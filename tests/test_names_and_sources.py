from __future__ import annotations

import pytest
from pyspark.sql import types as T

import tabclean as tc
from tabclean.sources import scratch
from tabclean.sources.scratch import materialize, scratch_root, staged


@pytest.fixture
def csv(tmp_path):
    def write(text, name="raw.csv"):
        path = tmp_path / name
        path.write_text(text, newline="")
        return str(path)

    return write


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Encounter ID ", "Total Cost USD", "\tx"])
    assert tc.normalize_names(df).columns == ["encounter_id", "total_cost_usd", "x"]


def test_names_that_collide(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["A b", "a_b", "a_b_2", "A_B"])
    with pytest.raises(ValueError, match="a_b"):
        tc.normalize_names(df)
    fixed = tc.normalize_names(df, on_collision="suffix")
    assert fixed.columns == ["a_b", "a_b_3", "a_b_2", "a_b_4"]
    assert tuple(fixed.first()) == (1, 2, 3, 4)
    with pytest.raises(ValueError, match="on_collision"):
        tc.normalize_names(df, on_collision="drop")


def test_names_differing_in_case_only_do_not_overwrite(spark):
    df = spark.createDataFrame([(1, 2)], ["x", "X"])
    assert tc.normalize_names(df, on_collision="suffix").columns == ["x", "x_2"]


def test_rename_positional_keeps_later_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert tc.rename_positional(df, ["x", "y"]).columns == ["x", "y", "c"]
    with pytest.raises(ValueError):
        tc.rename_positional(df, ["x", "y", "z", "w"])


def test_schema_report(spark, rows):
    df = spark.createDataFrame([], "a int, b array<string>")
    assert rows(tc.schema_report(df)) == [("a", "int"), ("b", "array<string>")]


def test_inference_and_declared_types(spark, csv):
    path = csv("id,n\n007,1\n008,2\n")
    inferred = tc.read_raw(spark, path)
    assert dict(inferred.dtypes) == {"id": "int", "n": "int"}
    typed = tc.read_raw(spark, path, types={"n": "int"})
    assert [tuple(r) for r in typed.collect()] == [("007", 1), ("008", 2)]


def test_declared_types_follow_the_header_not_the_position(spark, csv):
    path = csv("Total Cost USD, Encounter ID \n1.5,007\n")
    df = tc.read_raw(spark, path, types={"encounter_id": "string", "total_cost_usd": "double"})
    assert tuple(tc.normalize_names(df).first()) == (1.5, "007")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        tc.read_raw(spark, str(tmp_path), types={"a": "int"}).collect()


def test_bad_numbers_stop_the_job_unless_asked(spark, csv):
    path = csv("n.x,t\n1,a\n 2 ,b\nabc,c\n")
    with pytest.raises(Exception, match="abc"):
        tc.read_raw(spark, path, types={"n.x": "int"}).collect()
    lenient = tc.read_raw(spark, path, types={"n.x": "int"}, on_bad_value="null")
    assert [tuple(r) for r in lenient.collect()] == [(1, "a"), (2, "b"), (None, "c")]
    with pytest.raises(ValueError, match="on_bad_value"):
        tc.read_raw(spark, path, types={}, on_bad_value="skip")


def test_short_lines_and_empty_fields_are_null(spark, csv):
    path = csv('a,b,c\n1,"",x\n2\n')
    df = tc.read_raw(spark, path, types={"a": "int"})
    assert [tuple(r) for r in df.collect()] == [(1, None, "x"), (2, None, None)]


def test_explicit_schema_runs_no_job(spark, csv):
    path = csv("a,b\n1,x\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert tuple(tc.read_raw(spark, path, schema=schema).first()) == (1, "x")


def test_quoted_line_breaks(spark, csv):
    path = csv('id,note\n1,"first\nsecond ""quoted"" line"\n2,x\n')
    df = tc.read_raw(spark, path, types={}, multiline=True)
    assert [tuple(r) for r in df.collect()] == [("1", 'first\nsecond "quoted" line'), ("2", "x")]


def test_several_paths(spark, csv):
    paths = [csv("a\n1\n", "x.csv"), csv("a\n2\n", "y.csv")]
    assert sorted(r.a for r in tc.read_raw(spark, paths, types={"a": "int"}).collect()) == [1, 2]


def test_write_replaces_the_target(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    tc.write_curated(spark.range(5), path)
    tc.write_curated(spark.range(2), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_partitioned_write_splits_by_folder(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'cold' END AS part")
    tc.write_curated(df, str(path), partition_by=["part"])
    assert sorted(p.name for p in path.iterdir() if p.is_dir()) == ["part=cold", "part=hot"]
    assert spark.read.parquet(str(path)).count() == 1000


def test_scratch_tables(spark, rows):
    df = spark.range(3).toDF("n")
    assert rows(materialize(df, "t")) == [(0,), (1,), (2,)]
    with staged(df, "t") as kept:
        path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    class Conf(dict):
        pass

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({f"spark.{k.replace('_', '.')}": v for k, v in conf.items()})

    assert scratch_root(Session(checkpoint_dir="hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(master="yarn"))
    monkeypatch.setattr(scratch, "_local_root", {"app": "/tmp/known"})
    assert scratch_root(Session(master="local[4]", app_id="app")) == "/tmp/known"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_surplus_fields_and_bad_values_stop_the_job_in_any_mode(spark, csv, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        surplus = csv("a,b\ne1,x\ne2\ne1,,EXTRA\n", "surplus.csv")
        with pytest.raises(Exception, match="more than 2 fields"):
            tc.read_raw(spark, surplus, types={}).collect()
        with pytest.raises(Exception, match="more than 2 fields"):
            tc.read_raw(spark, surplus, types={}).select("a").collect()
        lenient = tc.read_raw(spark, surplus, types={}, on_bad_value="null")
        assert [tuple(r) for r in lenient.collect()] == [("e1", "x"), ("e2", None), ("e1", None)]
        bad = csv("n\n1\n2.5\n", "bad.csv")
        with pytest.raises(Exception, match="2.5"):
            tc.read_raw(spark, bad, types={"n": "int"}).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("multiline", [True, False])
def test_quotes_and_inferred_columns(spark, csv, multiline):
    path = csv('id,name,beds,flag\n007,"St. ""Mary"", North",3.0,True\n8,x,2,False\n')
    df = tc.read_raw(spark, path, types={"id": "string"}, multiline=multiline, infer_rest=True)
    assert [tuple(r) for r in df.collect()] == [("007", 'St. "Mary", North', 3.0, True), ("8", "x", 2.0, False)]
