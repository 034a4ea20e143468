"""CSV records: bad ones told apart, quoted line breaks across splits, types from the data."""

import random

import pytest
from pyspark.sql import functions as F

import tabclean as tc
from tabclean.sources import scan_raw
from tabclean.sources.inference import count_kinds, narrowest, resisting
from tabclean.sources.records import line_records


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path / name)

    return write


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def tuples(df):
    return [tuple(r) for r in df.collect()]


SURPLUS = "a,b\ne1,x\ne2\ne1,,EXTRA\n"


@pytest.mark.parametrize("multiline", [True, False])
def test_good_files_give_the_same_rows_whatever_is_read(spark, csv, multiline):
    df = tc.read_raw(spark, csv("a,b\ne1,x\ne2\n,\n"), types={"a": "string"}, multiline=multiline)
    assert df.count() == 3
    assert tuples(tc.row_count(df)) == [(3,)]
    assert sorted(tuples(df.select("b")), key=repr) == [("x",), (None,), (None,)]
    assert df.groupBy().agg(F.count("a")).first()[0] == 2


@pytest.mark.parametrize("multiline", [True, False])
@pytest.mark.parametrize(
    "act",
    [
        lambda df: df.count(),
        lambda df: df.collect(),
        lambda df: df.select("a").collect(),
        lambda df: df.select("b").distinct().collect(),
        lambda df: tc.distinct_values(df, "a").collect(),
        lambda df: tc.row_count(df).collect(),
        lambda df: df.select(F.lit(1)).collect(),
    ],
)
def test_surplus_fields_stop_every_read(spark, csv, act, multiline):
    df = tc.read_raw(spark, csv(SURPLUS), types={}, multiline=multiline)
    with pytest.raises(Exception, match="more than 2 fields: e1,,EXTRA"):
        act(df)


def test_bad_values_stop_reads_of_other_columns(spark, csv):
    df = tc.read_raw(spark, csv("n,t\n1,a\nabc,b\n"), types={"n": "int"})
    for act in (lambda: df.count(), lambda: df.select("t").collect()):
        with pytest.raises(Exception, match="column n: not of type int: abc"):
            act()


@pytest.mark.parametrize("multiline", [True, False])
def test_bad_records_are_a_second_output(spark, csv, multiline):
    text = 'n,t\n1,a\n2\n3,b,\n4,c,,EXTRA\nx,"d, ""e"""\n5,"f,g",\n,h\n6,i,j\n"7","k"\n'
    path = csv(text)
    scan = scan_raw(spark, path, {"n": "int"}, multiline=multiline)
    bad = [(r["record"], r["reason"]) for r in scan.bad_records().collect()]
    assert sorted(bad) == sorted(
        [
            ("3,b,", "more than 2 fields: 3,b,"),
            ("4,c,,EXTRA", "more than 2 fields: 4,c,,EXTRA"),
            ('x,"d, ""e"""', "column n: not of type int: x"),
            ('5,"f,g",', 'more than 2 fields: 5,"f,g",'),
            ("6,i,j", "more than 2 fields: 6,i,j"),
        ]
    )
    assert all(r["file"].endswith("/in.csv") for r in scan.bad_records().collect())
    good = [(1, "a"), (2, None), (None, "h"), (7, "k")]
    assert sorted(tuples(scan.rows("drop")), key=repr) == sorted(good, key=repr)
    assert scan.rows("drop").count() == len(good) and scan.rows("null").count() == 9
    assert (None, 'd, "e"') in tuples(scan.rows("null"))


def test_lines_keep_odd_characters(spark, csv):
    path = csv('a b,"c,d"\r\n\\x\t ,\x01\r\n  \r\n"q""",z\r\n')
    records = [r["record"] for r in line_records(spark, path).collect()]
    assert records == ["\\x\t ,\x01", '"q""",z']


def test_file_order_and_preview(spark, tmp_path, small_splits):
    for name, start in (("b.csv", 1000), ("a.csv", 0)):
        lines = "".join(f"{start + i},row {start + i}\n" for i in range(400))
        (tmp_path / name).write_text("Position,file\n" + lines)
    small_splits(2048)
    for multiline in (False, True):
        scan = scan_raw(spark, str(tmp_path), {"position": "int"}, multiline=multiline)
        assert tuples(scan.preview(4)) == [(i + 1, i, f"row {i}") for i in range(4)]
        placed = scan.rows("error", "place").orderBy("place").select("Position")
        assert [r[0] for r in placed.collect()] == [*range(400), *range(1000, 1400)]


def note(rng):
    """A field that holds commas, doubled quotes and line breaks of both kinds."""
    parts = ["word", '""', "\n", "\r\n", ",", " ", "é日", '"",""', '\n""\n']
    text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
    return f'"{text}"' if any(c in text for c in ',"\n\r') or rng.random() < 0.2 else text


@pytest.mark.parametrize(("size", "count"), [(64, 9), (1500, 120)])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, small_splits, size, count, end):
    rng = random.Random(size)
    for name in ("x.csv", "y.csv"):
        rows = [f"{i},{note(rng)},{note(rng)}" for i in range(count)]
        rows.insert(count // 2, f'7,"{"long " * (size // 5)}{end}""{end}",x')
        (tmp_path / name).write_bytes(end.join(["id,one,two", *rows]).encode() + (end.encode() if name == "x.csv" else b""))
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    expected = sorted(tuples(whole), key=repr)
    small_splits(size)
    found = tc.read_raw(spark, str(tmp_path), types={"id": "string"}, multiline=True)
    assert sorted(tuples(found), key=repr) == expected and len(expected) == 2 * count + 2
    assert found.count() == found.select("two").count() == len(expected)


def test_quoted_files_without_breaks_or_rows(spark, csv, tmp_path):
    assert tuples(tc.read_raw(spark, csv("a,b\n"), types={"a": "int"}, multiline=True)) == []
    assert tuples(tc.read_raw(spark, csv("\n\na,b\n\n1,x\n\n"), types={"a": "int"}, multiline=True)) == [(1, "x")]
    open_end = csv('a,b\n1,"never\nclosed')
    assert tuples(tc.read_raw(spark, open_end, types={}, multiline=True))[0][0] == "1"
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    (folder / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header differs"):
        tc.read_raw(spark, str(folder), types={}, multiline=True).collect()


COLUMNS = {
    "i": ["1", "-2", "+3", "007"],
    "l": ["1", "3000000000", None],
    "dec": ["1", "123456789012345678901"],
    "dbl": ["1", "2.5", "1e3", "NaN"],
    "d": ["2020-01-02", None, "1999-12-31"],
    "ts": ["2020-01-02 10:00:00", "2020-01-03 11:30:00"],
    "both": ["2020-01-02", "2020-01-03 11:30:00"],
    "b": ["true", "FALSE"],
    "mixed": ["1", "x"],
    "padded": [" 1", "2 "],
    "odd": ["2020-13-45", "1"],
    "words": ["nan", "1"],
    "none": [None, None],
}


def test_types_are_those_of_spark(spark, tmp_path):
    rows = [[(v[i] if i < len(v) else None) or "" for v in COLUMNS.values()] for i in range(4)]
    path = tmp_path / "t.csv"
    path.write_text("\n".join([",".join(COLUMNS), *[",".join(r) for r in rows]]) + "\n")
    reader = spark.read.option("header", True)
    expected = dict(reader.option("inferSchema", True).csv(str(path)).dtypes)
    expected = {c: t if t != "void" else "string" for c, t in expected.items()}
    found = tc.read_raw(spark, str(path), types={}, infer_rest=True)
    assert dict(found.dtypes) == expected
    assert tuples(found.select("i", "dbl").where("i = 7")) != []


def test_numeric_takes_the_type_that_resists_least(spark, csv):
    path = csv("beds,rate,none\n3,1,\nN/A,2.5,\n4,N/A,\n")
    types = dict.fromkeys(("beds", "rate", "none"), "numeric")
    with pytest.raises(Exception, match="not of type"):
        tc.read_raw(spark, path, types=types).count()
    lenient = tc.read_raw(spark, path, types=types, on_bad_value="null")
    assert dict(lenient.dtypes) == {"beds": "int", "rate": "double", "none": "double"}
    assert tuples(lenient) == [(3, 1.0, None), (None, 2.5, None), (4, None, None)]


def test_counts_of_resisting_values(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,), ("9" * 12,)], "v string")
    counts = count_kinds(df, ["v"])["v"]
    assert [resisting(counts, t) for t in ("int", "bigint", "double", "string")] == [3, 2, 1, 0]
    assert narrowest(counts) == "string"
    report = {r["type"]: (r["resisting"], r["fits"]) for r in tc.type_report(df).collect()}
    assert report["double"] == (1, False) and report["string"] == (0, True)
    assert tc.type_report(df.select(F.lit(1).alias("n"))).collect() == []


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "out")
    tc.write_curated(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("half way")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        tc.write_curated(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    tc.write_curated(spark.read.parquet(path).where("id < 2"), path)  # from itself
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_scratch_scopes_remove_what_they_made(spark):
    with tc.scratch_scope(spark):
        inner = tc.materialize(spark.range(3), "inner")
        kept = tc.materialize(spark.range(4), "kept", keep=True)
        assert inner.count() == 3
    assert kept.count() == 4
    with pytest.raises(Exception, match="(?i)not_exist|no such file|does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(inner.inputFiles()[0]).count()
