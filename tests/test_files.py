"""Readers and writers."""

import datetime as dt

from pyspark.sql import types as T

from eventloom.sources import files


def test_preamble_is_left_out_of_every_file(spark, tmp_path):
    for name, rows in (("a", ["1\tx", "2\ty"]), ("b", ["3\tz"]), ("c", [])):
        (tmp_path / f"{name}.tsv").write_text("\n".join(["p1", "p2", "p3", "n\ts", *rows]) + "\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    got = files.read_tsv_after_preamble(spark, str(tmp_path), schema, skip=3)
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (2, "y"), (3, "z")]


def test_preamble_with_a_file_cut_into_splits(spark, tmp_path):
    lines = ["p", "n\ts", *[f"{i}\tv{i}" for i in range(5000)]]
    (tmp_path / "big.tsv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = files.read_tsv_after_preamble(spark, str(tmp_path), schema, skip=1)
        assert got.rdd.getNumPartitions() > 3
        assert sorted(r.n for r in got.collect()) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_typed_csv_selects_by_name(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as out:
        out.write("click_id,ip,app,device,os,channel,click_time,is_attributed\n4294967295,4000000000,1,2,3,4,2024-01-02 03:04:05,1\n")
    row = files.read_typed_csv(spark, path, columns=["ip", "click_id", "click_time"]).first()
    assert tuple(row) == (4000000000, 4294967295, dt.datetime(2024, 1, 2, 3, 4, 5))


def test_file_order_wins_over_the_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("click_id,os,channels\n1,7,9\n")
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("click_id", "os", "channels")])
    row = files.read_in_file_order(spark, str(tmp_path), ["click_id", "channels", "os"], ["click_id", "os", "channels"], schema).first()
    assert tuple(row) == (1, 9, 7)


def test_reuse_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.reuse_or_build(spark, str(tmp_path / "t"), build).count() == 3
    assert len(calls) == 1


def test_submission_digits(spark, tmp_path):
    df = spark.createDataFrame([(1, 1 / 3), (2, 1e-12)], "click_id int, p double")
    files.write_submission(df, str(tmp_path / "s"), "click_id", "p")
    got = files.read_csv_columns(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, got.collect())) == [("1", "0.333333333"), ("2", "0.000000000")]


def test_dated_name():
    assert files.dated_name("glm_", dt.date(2018, 4, 5)) == "glm_2018-04-05.csv"
