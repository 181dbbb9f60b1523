import pytest

from leadframe.sources import files


@pytest.fixture
def folder(tmp_path):
    def write(**texts):
        where = tmp_path / "in put %41"
        where.mkdir()
        for name, text in texts.items():
            (where / f"{name} x.csv").write_bytes(text.encode())
        return str(where)
    return write


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_two_orders(spark, folder):
    got = files.read_delimited(spark, folder(one="a,b\n1,2\n", two="b,a\n3,4\n"))
    assert got.columns == ["a", "b"] and rows(got) == [("1", "2"), ("4", "3")]


def test_marks_missing_further_and_repeated_columns(spark, folder):
    path = folder(one="﻿key,name\r\n1,x\r\n\r\n", two='name,key,"a, b"\n"y ""q""\nz",2,é\n', three="key,key,extra\n3,4,5\n", four="key\n", five="name\n9,cut\n")
    got = files.read_delimited(spark, path, ("key", "none"), multi_line=True)
    assert got.columns == ["key", "none", "a, b", "extra", "name"]
    assert rows(got) == sorted([("1", None, None, None, "x"), ("2", None, "é", None, 'y "q"\nz'), ("4", None, None, "5", None),
                                (None, None, None, None, "9")], key=str)


def test_many_files_of_few_layouts_and_large_ones(spark, folder):
    many = {f"f{i}": ("a;b\n" if i % 2 else "b;a\n") + f"{i};{i}\n" for i in range(20)}
    long = "b;a\n" + "".join(f"{i};{-i}\n" for i in range(200_000))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # the long file is read by several tasks
    try:
        got = files.read_delimited(spark, folder(**many, long=long), ("a", "b"), ";")
        assert got.count() == 200_020 and got.where("a <> b AND cast(a AS int) <> -cast(b AS int)").count() == 0
        assert got.where("a = '-7'").collect() == [("-7", "7")] and got.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_one_promised_layout(spark, folder):
    got = files.read_delimited(spark, folder(one="﻿b,a\n1,2\n"), ("a",), one_layout=True)
    assert got.columns == ["a", "b"] and rows(got) == [("2", "1")]
