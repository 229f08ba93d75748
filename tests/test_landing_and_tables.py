from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyward.contracts import CASHIERS
from tallyward.sources import tables
from tallyward.streaming import landing


def test_files_land_once_and_by_column_name(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "raw", "state"))
    (tmp_path / "in").mkdir()

    def land():
        landing.land(spark, inbox, table, state, CASHIERS)
        return {r["cashier_id"]: r for r in landing.read_raw(spark, table, CASHIERS).collect()}

    (tmp_path / "in" / "a.csv").write_text("cashier_id,store_id\nC1,S1\nC2, S2 \n")
    first = land()
    assert first["C1"]["store_id"] == "S1" and first["C1"]["_rescued_data"] is None
    assert first["C1"]["_source_file"].endswith("a.csv") and first["C1"]["_ingested_at"] is not None
    assert land() == first

    (tmp_path / "in" / "b.csv").write_text('store_id,"note, long",cashier_id\nS3,"x, y",C3\nS4,,C4\n')
    (tmp_path / "in" / "c.csv").write_text("cashier_id\nC5\n")
    (tmp_path / "in" / "d.csv").write_text("cashier_id,store_id\nC6,S6,surplus\n")
    got = land()
    assert len(got) == 6 and got["C1"] == first["C1"]
    assert got["C3"]["store_id"] == "S3" and json.loads(got["C3"]["_rescued_data"]) == {"note, long": "x, y"}
    assert got["C4"]["_rescued_data"] is None and got["C5"]["store_id"] is None
    assert got["C6"]["_rescued_data"] == "C6,S6,surplus"


def test_every_name_and_any_number_of_layouts_lands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "SCANS", 2)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("cashier_id,store_id\nC1,S1\n")
    (tmp_path / "in" / "b.csv.gz").write_bytes(gzip.compress(b"cashier_id,store_id\nC2,S2\n"))
    (tmp_path / "in" / "c.CSV").write_text("\ufeffstore_id,cashier_id\nS3,C3\n")
    (tmp_path / "in" / "delivery").write_text("cashier_id\nC4\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    for k in range(5):
        (tmp_path / "in" / f"odd {k}.csv").write_text(f"extra{k},cashier_id\n{k},X{k}\n")
    landing.land(spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "state"), CASHIERS)
    got = {r["cashier_id"]: (r["store_id"], r["_rescued_data"]) for r in landing.read_raw(spark, str(tmp_path / "raw"), CASHIERS).collect()}
    assert got == {"C1": ("S1", None), "C2": ("S2", None), "C3": ("S3", None), "C4": (None, None), **{f"X{k}": (None, f'{{"extra{k}":"{k}"}}') for k in range(5)}}


def test_first_lines_are_read_in_tasks_of_one_file(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"f {k}+%.csv").write_text(f"head{k},b\n" + "x,y\n" * (20_000 if k == 0 else k % 3))
    (tmp_path / "big.csv.gz").write_bytes(gzip.compress(b"\xef\xbb\xbfzipped,b\n" + b"1,2\n" * 50_000))
    (tmp_path / "bare.csv").write_text("only a header")
    (tmp_path / "blank.csv").write_text("\nx\n")
    (tmp_path / "empty.csv").write_text("")
    kept = {k: spark.conf.get(k) for k in landing.WHOLE_FILES}
    paths = [f"file:{p}" for p in sorted(tmp_path.iterdir())]
    got = {name.rsplit("/", 1)[1]: line for name, line in landing.first_lines(spark, paths).items()}
    assert got == {**{f"f {k}+%.csv": f"head{k},b" for k in range(60)}, "big.csv.gz": "zipped,b", "bare.csv": "only a header", "blank.csv": ""}
    assert {k: spark.conf.get(k) for k in landing.WHOLE_FILES} == kept
    assert landing.first_lines(spark, []) == {}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("cashier_id,store_id\nC1,S1\n")
    for state in ("one", "two"):  # the second run starts over with batch 0, as after a failure before its commit
        landing.land(spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / state), CASHIERS)
    assert landing.read_raw(spark, str(tmp_path / "raw"), CASHIERS).count() == 1


def test_slices_are_replaced_even_by_nothing(spark):
    spark.sql("DROP TABLE IF EXISTS slices")
    tables.create_quarantine(spark, "slices")
    tables.create_quarantine(spark, "slices")  # only if missing

    def held(*keys):
        df = spark.createDataFrame([(k,) for k in keys], "record_key string")
        return df.select(
            F.lit(None).cast("string").alias("source"), "record_key", F.array(F.lit("r")).alias("reasons"), F.lit("{}").alias("record"),
            F.lit("f").alias("_source_file"), F.current_timestamp().alias("_ingested_at"), F.current_timestamp().alias("_quarantined_at"),
        )

    tables.replace_slice(held("a", "b"), "slices", "source", "x")
    tables.replace_slice(held("c"), "slices", "source", "y")
    tables.replace_slice(held("d"), "slices", "source", "x")
    assert rows(spark.table("slices").select("source", "record_key"), "record_key") == [("y", "c"), ("x", "d")]
    tables.replace_slice(held(), "slices", "source", "x")
    assert rows(spark.table("slices").select("record_key")) == [("c",)]


def test_history_and_comments(spark):
    for n in ("kept", "refreshed"):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    for x in (1, 2):
        tables.append_history(spark.sql(f"select {x} as x"), "kept", "at")
    assert spark.table("kept").count() == 2
    tables.replace_table(spark.sql("select 1 as x"), "refreshed")
    tables.replace_table(spark.sql("select 'a' as y, 2 as z"), "refreshed")
    tables.describe_table(spark, "refreshed", {"quality": "gold"}, {"y": "it's a text", "absent": "no"})
    assert spark.table("refreshed").columns == ["y", "z"]
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE refreshed").collect()}
    assert comments["y"] == "it's a text"
    assert tables.table_or_none(spark, "nowhere") is None


def test_a_repeated_run_replaces_its_own_history(spark):
    spark.sql("DROP TABLE IF EXISTS by_run")
    one = spark.sql("select 1 as x, double('NaN') as y")
    for run, times in (("it's run 1", 2), ("run 2", 1)):
        for _ in range(times):
            tables.append_history(one, "by_run", "at", run)
    assert rows(spark.table("by_run").select("x", "y", tables.SLICE), tables.SLICE) == [(1, None, "it's run 1"), (1, None, "run 2")]
    tables.append_history(one.where("false"), "by_run", "at", "run 2")
    assert spark.table("by_run").count() == 1


@pytest.mark.parametrize("by", [(), ("k",)])
def test_readers_of_a_replaced_table_never_meet_a_gap(spark, by):
    spark.sql("DROP TABLE IF EXISTS swapped")
    version = lambda x: spark.sql(f"select id, id % 3 as k, {x} as x from range(30)")
    held = lambda df: {(r["x"], r["n"]) for r in df.groupBy("x").agg(F.count("*").alias("n")).collect()}
    tables.replace_table(version(1), "swapped", by)
    tables.describe_table(spark, "swapped", {"quality": "gold"}, {"x": "version"})
    old = spark.table("swapped")
    tables.replace_table(version(2), "swapped", by)
    assert held(old) == {(1, 30)} and held(spark.table("swapped")) == {(2, 30)}
    with pytest.raises(Exception, match="dies on the way"):
        tables.replace_table(version(3).where("id < 29 or raise_error('dies on the way') is null"), "swapped", by)
    assert held(spark.table("swapped")) == {(2, 30)}
    tables.replace_table(spark.table("swapped").where("k < 2"), "swapped", by)  # reads what it replaces
    assert held(spark.table("swapped")) == {(2, 20)}
    assert [r["comment"] for r in spark.sql("DESCRIBE swapped").collect() if r["col_name"] == "x"] == ["version"]
    folder = spark._jvm.java.io.File(tables.versions_folder(spark, "swapped").removeprefix("file:"))
    assert len(folder.list()) == 2  # this version and the one before; the failed one is gone
    tables.replace_table(version(4).drop("id").withColumn("y", F.lit("a")), "swapped", by)
    assert spark.table("swapped").where("y = 'a'").count() == 30 and sorted(spark.table("swapped").columns) == ["k", "x", "y"]
    if by:
        tables.replace_slice(spark.sql("select 9 as x, 'b' as y"), "swapped", "k", "1")
        assert held(spark.table("swapped")) == {(4, 20), (9, 1)}


def test_nan_and_infinity_become_null_at_any_depth(spark):
    df = spark.sql("""select double('NaN') as a, array(float('infinity'), float(1)) as b, named_struct('x', -double('infinity'), 'y', 'NaN') as c,
        map('k', array(double('NaN'), 2D)) as d, cast(null as struct<z: double>) as e, 'NaN' as f""")
    got = tables.finite(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert tuple(got.first()) == (None, [None, 1.0], (None, "NaN"), {"k": [None, 2.0]}, None, "NaN")
