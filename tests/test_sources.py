"""Files and tables."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom.operators import staging_area
from starloom.sources import catalog, files, toll


def test_course_csv_with_mark_and_line_breaks(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes(b'\xef\xbb\xbfcourse_id,Title\n1,"two\nlines, ""quoted"""\n2,plain\n')
    got = files.read_course_csv(spark, str(path), ["course_id", "Title"])
    assert rows(got) == [("1", 'two\nlines, "quoted"'), ("2", "plain")]


def test_course_csv_columns_go_by_their_names(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Language,Extra,course_id\nen,x,7\n")
    assert rows(files.read_course_csv(spark, str(path), ["course_id", "Language"])) == [("7", "en")]
    with pytest.raises(ValueError, match="Title"):
        files.read_course_csv(spark, str(path), ["course_id", "Title"])


def test_json_array_and_lines(spark, frame, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "x": "a"}, {"id": 2}]')
    assert rows(files.read_json_records(spark, str(tmp_path / "a.json"), "id int, x string")) == [(1, "a"), (2, None)]
    out = str(tmp_path / "out")
    files.write_json_records(frame([(1, None)], "id int, x string"), out)
    assert '"x":null' in "".join(r[0] for r in spark.read.text(out).collect())


def test_csv_sink(spark, frame, tmp_path):
    out = str(tmp_path / "csv")
    files.write_csv(frame([(1, "a")], "id int, x string"), out)
    files.write_csv(frame([(2, "b")], "id int, x string"), out, mode="append")
    assert rows(files.read_columns(spark, out, ["id", "x"], [2, 1])) == [("a", "1"), ("b", "2")]
    files.write_csv(frame([(3, "c")], "id int, x string"), out)
    assert spark.read.option("header", True).csv(out).count() == 1
    with pytest.raises(ValueError):
        files.write_csv(frame([(3,)], "id int"), out, mode="ignore")


def test_failed_ids(frame):
    log = frame([("x All retries failed: http://h/api-2.0/courses/12/ y",), ("All retries failed: api-2.0/courses/12/",), ("fine",)], "value string")
    assert rows(files.failed_ids(log)) == [("12",)]


def test_toll_job(spark, tmp_path):
    (tmp_path / "v.csv").write_text("Rowid,Timestamp,VehicleNumber,VehicleType\n" + "".join(f"{i},t{i},V{i},car\n" for i in range(1, 6)))
    head = "Rowid\tTimestamp\tVehicleNumber\tVehicleType\tTollPlazaID\tTollPlazaCode\tPaymentCode\n"
    (tmp_path / "p.tsv").write_text(head + "".join(f"{i}\tt\tV\tcar\t{100 + i}\tTP{i}\tC\n" for i in range(1, 6)))
    (tmp_path / "f.txt").write_text("".join(f"0000{i} CASH      tail\n" for i in range(1, 5)))
    got = toll.upper_column(
        toll.consolidate(
            files.read_vehicles(spark, str(tmp_path / "v.csv")), files.read_toll_plazas(spark, str(tmp_path / "p.tsv")),
            files.read_payments(spark, str(tmp_path / "f.txt")),
        ), "VehicleType",
    ).collect()
    assert [tuple(r) for r in got[:2]] == [
        ("1", "t1", "V1", "CAR", "101", "TP1", "C", "00001", "CASH      "), ("2", "t2", "V2", "CAR", "102", "TP2", "C", "00002", "CASH      ")
    ]
    assert got[4]["row_number"] is None and got[4]["TollPlazaID"] == "105"


def test_lines_are_numbered_over_many_files(spark, tmp_path):
    sizes = [3, 50, 7, 20]
    start = 0
    for n, size in enumerate(sizes):
        (tmp_path / f"part-{n}.txt").write_text("".join(f"{i}\n" for i in range(start, start + size)))
        start += size
    numbered = toll.number_lines(spark.read.text(str(tmp_path)), "line")
    assert numbered.filter(F.col("value").cast("int") + 1 != F.col("line")).count() == 0 and numbered.count() == 80


def test_relations_by_pattern(spark, frame):
    for n in (1, 2, 3):
        frame([(n, "play"), (n, "pause")], "user_id int, event string").createOrReplaceTempView(f"evt_2018010{n}")
    frame([(9, "x")], "user_id int, event string").createOrReplaceTempView("evt_old")
    assert list(catalog.relations_by_prefix(spark, "%", "EVT_", "%old")) == ["evt_20180101", "evt_20180102", "evt_20180103"]
    assert catalog.union_by_pattern(spark, "%", "evt_2018%").count() == 6
    assert list(catalog.relations_by_pattern(spark, "%", "evt-old")) == []


def test_materialize(spark, frame, tmp_path):
    df = frame([(1,)], "x int")
    assert rows(catalog.materialize(df, "as_view")) == [(1,)]
    assert rows(catalog.materialize(df, "as_table", as_table=True, path=str(tmp_path / "t"))) == [(1,)]


def test_a_session_without_a_checkpoint_folder_stages_under_its_warehouse():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "file:/shared/warehouse/"}.get(key, default)

    class Context:
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    assert staging_area.staging_root(Session()) == "file:/shared/warehouse"


def test_release_removes_what_was_staged(frame, spark):
    staged = staging_area.stage(frame([(1,), (2,)], "x int"), "probe")
    folder = staged.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    staging_area.release(spark)
    assert not os.path.isdir(folder)


def test_staged_tables_need_a_shared_folder():
    """On a cluster a warehouse on the machines' own disks is no place for tables that other executors read."""
    for root in ("file:/work/spark-warehouse", "/work/spark-warehouse", "spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging_area._shared(root, "yarn")
        assert staging_area._shared(root, "local[8]") == root
    assert staging_area._shared("hdfs://store/warehouse", "spark://host:7077") == "hdfs://store/warehouse"
