import tempfile

from propensity.sources import tables
from propensity.sources.fixture import prospects
from conftest import SF001


def test_csv_roundtrip_typed(spark):
    path = tempfile.mkdtemp(prefix="csv-") + "/raw"
    raw = prospects(spark, SF001)
    tables.write_csv(raw, path)
    back = tables.read_csv(spark, path)
    assert back.dtypes == raw.dtypes
    assert back.exceptAll(raw).count() == 0


def test_catalog_lifecycle(spark):
    tables.reset_database(spark, "propensity_test")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    tables.save_table(df, "propensity_test.t1", path=tempfile.mkdtemp(prefix="tbl-") + "/t1")
    names = [r.tableName for r in tables.list_tables(spark, "propensity_test").collect()]
    assert "t1" in names
    assert tables.read_table(spark, "propensity_test.t1").count() == 1
    tables.create_view(df, "v_tmp")
    assert spark.sql("select count(*) c from v_tmp").first().c == 1
    tables.drop_view(spark, "v_tmp")
    assert not spark.catalog.tableExists("v_tmp")
    tables.reset_database(spark, "propensity_test")


def test_clear_scratch_removes_only_own_tables(spark):
    import os
    from propensity.operators.sampling import materialize
    from propensity.session import clear_scratch, scratch_path
    t = materialize(spark.range(10), "scratch-test")
    assert t.count() == 10
    root = scratch_path(spark, "")
    assert os.path.isdir(root.replace("file:", ""))
    assert clear_scratch(spark) is True
    assert not os.path.exists(root.replace("file:", ""))
    assert os.path.isdir(spark.sparkContext.getCheckpointDir().replace("file:", ""))


def test_csv_header_and_values_are_checked(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="csv-")
    for name, text in (("order", "Gender,id,Age\n7,Male,3\n"), ("bad", "id,Gender,Age\n1,Male,abc\n")):
        with open(f"{root}/{name}.csv", "w") as f:
            f.write(text)
    schema = "id long, Gender string, Age int"
    with pytest.raises(Exception, match="(?i)header|schema"):
        tables.read_csv(spark, f"{root}/order.csv", schema).collect()
    with pytest.raises(Exception):
        tables.read_csv(spark, f"{root}/bad.csv", schema).collect()
    assert tables.read_csv(spark, f"{root}/bad.csv", schema, mode="PERMISSIVE").first().Age is None


def test_saved_view_reads_saved_tables(spark):
    tables.reset_database(spark, "views_test")
    tables.save_table(spark.range(5), "views_test.base", path=tempfile.mkdtemp(prefix="tbl-") + "/b")
    tables.create_saved_view(spark, "views_test.big", "SELECT id FROM views_test.base WHERE id > 2")
    assert spark.newSession().table("views_test.big").count() == 2
    tables.drop_view(spark, "views_test.big")
    tables.reset_database(spark, "views_test")


def test_saved_table_partitions(spark):
    path = tempfile.mkdtemp(prefix="tbl-") + "/p"
    tables.save_table(spark.range(100), "parts_tmp", partitions=3, path=path)
    assert len(spark.table("parts_tmp").inputFiles()) == 3
    tables.drop_table(spark, "parts_tmp")


def test_failed_overwrite_leaves_the_old_table(spark):
    import pytest
    from pyspark.sql import functions as F
    broken = spark.range(50).select(F.when(F.col("id") < 40, F.col("id")).otherwise(
        F.raise_error(F.lit("broken row")).cast("long")).alias("id"))
    tables.reset_database(spark, "safe_test")
    for name, path in (("safe_test.ext", tempfile.mkdtemp(prefix="tbl-") + "/e"), ("safe_test.man", None)):
        tables.save_table(spark.range(5), name, path=path)
        with pytest.raises(Exception, match="broken row"):
            tables.save_table(broken, name, path=path)
        assert spark.table(name).count() == 5
        tables.save_table(spark.table(name).where("id > 1"), name, path=path)       # reads what it replaces
        assert sorted(r.id for r in spark.table(name).collect()) == [2, 3, 4]
        tables.save_table(spark.createDataFrame([("a", 1)], "k string, v int"), name, path=path)
        assert [tuple(r) for r in spark.table(name).collect()] == [("a", 1)]
        tables.save_table(spark.createDataFrame([("b", 2)], "k string, v int"), name, path=path, mode="append")
        assert spark.table(name).count() == 2
    assert sorted(r.tableName for r in tables.list_tables(spark, "safe_test").collect()) == ["ext", "man"]
    tables.reset_database(spark, "safe_test")


def test_old_versions_go_with_the_next_overwrite(spark):
    import os
    path = tempfile.mkdtemp(prefix="tbl-") + "/v"
    for n in (1, 2, 3, 4):
        tables.save_table(spark.range(n), "versions_tmp", path=path)
    assert spark.table("versions_tmp").count() == 4
    assert len([d for d in os.listdir(path) if d.startswith("version-")]) == 2
    tables.drop_table(spark, "versions_tmp")


def test_checkpoint_folder_must_be_shared():
    from propensity.session import _shared
    assert not _shared("file:/tmp/x", "hdfs://h/") and not _shared("/tmp/x", "file:///") and not _shared("file:///x", "s3a://b")
    assert _shared("/data/x", "hdfs://h/") and _shared("s3a://b/x", "file:///")
