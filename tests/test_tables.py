import json
import os

import pytest
from pyspark.sql import functions as F

from feedkit.operators import merge_upsert
from feedkit.plans import create_loaded, create_snapshot, ledger, load_new_files, stage_load
from feedkit.sinks import append_by_name, create_table, overwrite_table, run_sql, truncate
from feedkit.sources import list_tables, preview, read_table
from feedkit.workdir import new_folder, shared_folder, written


def test_create_fill_and_truncate(spark, rows):
    create_table(spark, "t_fill", {"store_id": "varchar(5)", "value": "integer", "flag": "char"}, replace=True)
    assert spark.table("t_fill").dtypes == [("store_id", "string"), ("value", "int"), ("flag", "string")]
    run_sql(spark, "INSERT INTO t_fill VALUES ('A0001', 1000, 'Y')")
    assert rows(spark.table("t_fill")) == [("A0001", 1000, "Y")]
    truncate(spark, "t_fill")
    assert rows(spark.table("t_fill")) == []
    assert run_sql(spark, "SELECT version() AS v").first()["v"].startswith(spark.version)
    assert "t_fill" in {r["tableName"] for r in list_tables(spark).collect()}
    with pytest.raises(ValueError, match="together"):
        create_table(spark, "t_buckets", {"a": "int"}, buckets=4)


def test_append_by_name(spark, rows):
    create_table(spark, "t_append", {"a": "int", "b": "varchar"}, replace=True)
    append_by_name(spark.createDataFrame([("x", 1)], "B string, A int"), "t_append")
    assert rows(spark.table("t_append")) == [(1, "x")]
    with pytest.raises(ValueError, match="c"):
        append_by_name(spark.createDataFrame([(1, "x")], "a int, c string"), "t_append")


def test_overwrite_and_read(spark, rows, tmp_path):
    overwrite_table(spark.range(3), "t_over")
    overwrite_table(spark.range(2), "t_over")
    assert rows(read_table(spark, "t_over")) == [(0,), (1,)]
    assert rows(read_table(spark, query="SELECT count(*) FROM t_over")) == [(2,)]
    assert rows(preview(spark.table("t_over"), 1, ["id"])) == [(0,)]
    path = str(tmp_path / "out")
    overwrite_table(spark.range(2), "ignored", source="parquet", options={"path": path})
    append_by_name(spark.range(1), "ignored", source="parquet", options={"path": path})
    assert read_table(spark, "ignored", source="parquet", options={"path": path}).count() == 3
    with pytest.raises(ValueError, match="either"):
        read_table(spark)


def test_stage_load(spark, rows, tmp_path):
    data, mapping = tmp_path / "data.csv", tmp_path / "mapping.json"
    data.write_text("name;pay;town\nAnn;10;Rome\nBob;20;Oslo\n")
    mapping.write_text(json.dumps({"mappings": [
        {"source": {"name": "pay"}, "target": {"name": "salary", "type": "DOUBLE"}},
        {"source": {"name": "name"}, "target": {"name": "person"}},
    ]}))
    create_table(spark, "t_people", {"town": "varchar", "person": "varchar", "salary": "double"}, replace=True)
    for _ in range(2):
        stage_load(spark, str(data), str(mapping), "t_staging", "t_people", delimiter=";")
    assert rows(spark.table("t_people")) == [("Oslo", "Bob", 20.0)] * 2 + [("Rome", "Ann", 10.0)] * 2
    assert spark.table("t_staging").count() == 2


def test_merge(spark, rows):
    schema = "a int, b int, c int, d int, e int, start date, v string"
    target = spark.sql("""SELECT * FROM VALUES (1,1,1,1,1,date'2023-01-01','old'), (1,1,1,1,1,date'2022-01-01','older'),
        (1,1,1,1,2,null,'none') AS t(a,b,c,d,e,start,v)""")
    changes = spark.sql("""SELECT * FROM VALUES ('new',1,1,1,1,1,date'2023-01-01'), ('first',1,1,1,1,2,date'1901-01-01'),
        ('added',2,1,1,1,1,date'2023-01-01') AS t(V,A,B,C,D,E,START)""")
    result = merge_upsert(target, changes, list("abcde"), "start")
    assert result.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(r["v"] for r in result.collect()) == ["added", "first", "new", "older"]
    with pytest.raises(ValueError, match="v"):
        merge_upsert(target, changes.drop("V"), ["a"])


def test_snapshots(spark, rows):
    spark.sql("DROP VIEW IF EXISTS t_snapshot")
    create_snapshot(spark.range(1), "t_snapshot")
    create_snapshot(spark.table("t_snapshot").union(spark.range(5, 6)), "t_snapshot")
    assert rows(spark.table("t_snapshot")) == [(0,), (5,)]


def test_shared_folder(spark, rows):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert rows(written(spark.range(2), "w")) == [(0,), (1,)]


def test_several_changes_of_one_row_are_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError, match="several changes"):
        merge_upsert(target, twice, ["K"])


def test_append_to_an_external_table_goes_by_name(spark, tmp_path, rows, monkeypatch):
    """CSV files match by position; as the source they stand for a system that does."""
    from pyspark.sql import DataFrameReader, DataFrameWriter

    path = str(tmp_path / "external")
    spark.createDataFrame([(1, "x")], "a int, b string").write.csv(path)
    monkeypatch.setattr(DataFrameReader, "load", lambda self, *_: self.schema("a int, b string").csv(path))
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *_: self.csv(path))
    append_by_name(spark.createDataFrame([("y", 2)], "B string, A int"), "t", source="csv")
    assert rows(spark.read.schema("a int, b string").csv(path)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="only one"):
        append_by_name(spark.createDataFrame([(2,)], "a int"), "t", source="csv")


# ---------------------------------------------------------------- overwriting


def test_an_overwrite_that_is_cut_short_leaves_the_old_rows(spark, rows):
    """With the same columns and with others, in plain and partitioned tables."""

    def failing(name):
        return F.when(F.col(name) >= 0, F.raise_error(F.lit("CutShort")).cast("int"))

    old = spark.range(5).selectExpr("CAST(id AS INT) AS a", "'x' AS b")
    for name, partitions in (("ow_plain", []), ("ow_parts", ["b"])):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        old.write.partitionBy(*partitions).saveAsTable(name) if partitions else overwrite_table(old, name)
        for new in (old.select(failing("a").alias("a"), "b"), old.select(failing("a").alias("c"))):
            with pytest.raises(Exception, match="CutShort"):
                overwrite_table(new, name)
            assert rows(spark.table(name)) == rows(old)
        overwrite_table(old.where("a < 2"), name)
        assert rows(spark.table(name)) == rows(old.where("a < 2"))
        overwrite_table(old.select("b", (F.col("a") * 2).alias("n")), name)
        assert spark.table(name).columns == ["b", "n"]
        assert spark.table(name).count() == 5
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_overwriting_with_its_own_rows_and_readers_under_way(spark, rows):
    spark.sql("DROP TABLE IF EXISTS ow_self")
    overwrite_table(spark.range(100).selectExpr("id AS a"), "ow_self")
    spark.sql("ALTER TABLE ow_self SET TBLPROPERTIES ('owner.team' = 'x')")
    for k in range(3):
        reading = spark.table("ow_self").toLocalIterator() if k else iter(range(100))
        next(reading)
        overwrite_table(spark.table("ow_self").selectExpr("a + 1 AS a"), "ow_self")
        assert len(list(reading)) == 99
    assert spark.table("ow_self").agg(F.min("a"), F.max("a")).first() == (3, 102)
    assert spark.sql("SHOW TBLPROPERTIES ow_self ('owner.team')").first()["value"] == "x"


# ---------------------------------------------------------------- new files only


@pytest.fixture
def stage(spark, tmp_path):
    """A stage's folder, and a function that loads it into two tables and notes which files it reads."""
    (tmp_path / "in").mkdir()
    for name in ("st_rows", "st_mapped", "st_rows__files"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_loaded(spark, "st_rows", {"a": "VARCHAR", "b": "VARCHAR"})
    create_loaded(spark, "st_mapped", {"n": "INTEGER"})
    read = []

    def rows_of(paths):
        read.append(sorted(p.rpartition("/")[2] for p in paths))
        return spark.read.schema("b string, a string").csv(paths)

    def load(**options):
        read.clear()
        targets = {"st_mapped": lambda rows: rows.selectExpr("CAST(a AS INT) * 10 AS n")}
        return load_new_files(spark, str(tmp_path / "in"), rows_of, "st_rows", targets, pattern="*.csv", **options), list(read)

    return tmp_path / "in", load


def test_only_new_files_are_read_and_each_once(spark, rows, stage):
    folder, load = stage
    assert load() == ([], [])
    (folder / "one.csv").write_text("x,1\ny,2\n")
    (folder / "other.txt").write_text("no,0\n")
    assert load() == ([1], [["one.csv"]])
    assert load() == ([], [])
    (folder / "two.csv").write_text("z,3\n")
    (folder / "below").mkdir()
    (folder / "below" / "three.csv").write_text("w,4\n")
    os.utime(folder / "two.csv", (1e9, 1e9))  # the oldest is loaded first
    assert load(files_per_load=1)[0] == [2, 3]
    assert rows(spark.table("st_rows")) == [("1", "x", 1), ("2", "y", 1), ("3", "z", 2), ("4", "w", 3)]
    assert rows(spark.table("st_mapped"), "n") == [(10,), (20,), (30,), (40,)]
    assert {(r["path"].rpartition("/")[2], r["length"], r["load_number"]) for r in ledger(spark, "st_rows").collect()} == {("one.csv", 8, 1), ("two.csv", 4, 2), ("three.csv", 4, 3)}
    (folder / "two.csv").write_text("z,33\n")  # another length: another file
    assert load() == ([4], [["two.csv"]])


@pytest.mark.parametrize("cut_at", [0, 1, 2])
def test_a_load_of_files_that_is_cut_short_is_done_again(spark, rows, stage, monkeypatch, cut_at):
    import sys

    module = sys.modules["feedkit.plans.stage_load"]
    folder, load = stage
    (folder / "one.csv").write_text("x,1\n")
    load()
    (folder / "two.csv").write_text("y,2\n")
    add, done = module._add, []

    def stopping(*args):
        if len(done) == cut_at:
            raise RuntimeError("cut")
        done.append(1)
        return add(*args)

    with monkeypatch.context() as cut:
        cut.setattr(module, "_add", stopping)
        with pytest.raises(RuntimeError, match="cut"):
            load()
    (folder / "three.csv").write_text("z,3\n")
    assert load()[0] == [2]
    assert rows(spark.table("st_rows"), "a") == [("1",), ("2",), ("3",)]
    assert rows(spark.table("st_mapped"), "n") == [(10,), (20,), (30,)]
    with pytest.raises(ValueError, match="only one of rows and table"):
        module._add(spark.range(1), "st_rows", 9)
