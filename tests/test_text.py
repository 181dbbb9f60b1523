"""Text helpers against Python's own string functions."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadframe.functions import text as X

SAMPLES = [
    "", " ", "a", "  a  b ", "\xa0a b\n", "line\r\nnext\x85last", "\x1c x \x1f", "a\n\n \n b\n",
    "tabs\t\tand\x0bfeeds\x0c", " first second　", " \n\xa0\n ",
]


def test_strip(column):
    assert column(SAMPLES, X.py_strip) == [s.strip() for s in SAMPLES]


def test_collapse(column):
    expected = [re.sub(r"\s+", " ", s.strip()) for s in SAMPLES]
    assert column(SAMPLES, X.collapse_ws) == expected
    assert column([None], X.collapse_ws) == [""]


def test_nonblank_lines(column):
    expected = ["\n".join(l.strip() for l in s.splitlines() if l.strip()) for s in SAMPLES]
    assert column(SAMPLES, X.nonblank_lines) == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\r\x0b\x85\xa0 é", max_size=30), min_size=40, max_size=40))
def test_blanks_property(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", X.py_strip("t").alias("s"), X.collapse_ws("t").alias("c"),
                      X.nonblank_lines("t").alias("n")).orderBy("i").collect()
    for t, row in zip(texts, got):
        assert row.s == t.strip()
        assert row.c == re.sub(r"\s+", " ", t.strip())
        assert row.n == "\n".join(l.strip() for l in t.splitlines() if l.strip())


def test_long_blank_runs_are_linear(column):
    big = "x" + " " * 400_000 + "y" + "\n" * 200_000 + "z"
    assert column([big], X.nonblank_lines) == ["x" + " " * 400_000 + "y\nz"]
    assert column([big], X.collapse_ws) == ["x y z"]


def test_parse_int(column):
    texts = ["12", " 12 ", "-5", "+7", "12.5", "abc", "", None, "1e3", "9" * 38, "9" * 60]
    got = column(texts, X.parse_int)
    assert [None if v is None else int(v) for v in got] == \
        [12, 12, -5, 7, None, None, None, None, None, int("9" * 38), None]


def test_followers(spark):
    texts = ["FOLLOWERS\n1234\nFOLLOWING", "FOLLOWERS 1,234", "FOLLOWERS 12 345", "followers 3",
             "FOLLOWERS ,", None]
    value, status = X.parse_followers("t")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        value.alias("v"), status.alias("s")).collect()
    assert [(r.v, r.s) for r in rows] == [
        (1234, "ok"), (1234, "ok"), (12345, "ok"), (None, "not_found"), (None, "error"), (None, "not_found")]


def test_consent_head(spark):
    texts = ["We use Cookies\nb\nc\nd", "a\nb\nc\ncookie", "cookie\nb", "a", None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = X.drop_head_if_marked(rows, "t", "o", 3, ["cookie"]).orderBy("i").collect()
    assert [r.o for r in got] == ["d", "a\nb\nc\ncookie", "", "a", None, ""]


def test_clean_cell(column):
    assert column([" a\nb\r\nc "], X.clean_cell) == ["a b c"]


def test_timestamps(spark):
    texts = ["2025-03-01T10:00:00+0000", "2025-03-01T12:00:00+0200", "2025-03-01", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(X.parse_timestamp("t").cast("string").alias("v")).collect()
    assert [r.v for r in got] == ["2025-03-01 10:00:00", "2025-03-01 10:00:00", "2025-03-01 00:00:00", None, None]
    assert rows.where(F.lit(True)).count() == 5


def test_timestamp_forms(column):
    forms = ["2024-05-01T10:00:00", "2024-05-01T10:00:00Z", "2024-05-01T10:00:00.123Z", "2024-05-01T12:00:00.000+0200",
             "2024-05-01T12:00:00+02:00", "2024-05-01 10:00:00.5", "2024-05-01", "yesterday", None]
    shown = [None if v is None else v.isoformat(" ") for v in column(forms, X.parse_timestamp)]
    assert shown == ["2024-05-01 10:00:00", "2024-05-01 10:00:00", "2024-05-01 10:00:00.123000", "2024-05-01 10:00:00",
                     "2024-05-01 10:00:00", "2024-05-01 10:00:00.500000", "2024-05-01 00:00:00", None, None]
