import os

import pytest
from pyspark.sql import functions as F

from saltkv.sources import delimited as D
from saltkv.sources.spec import TableSpec

R, C = "\x10", "\x01"
SPEC = TableSpec(table_name="t", namespace="n", uniq_col="a", pre_regions=3, query_key=("b",), cols=("a", "b", "c"))


def _write(tmp, text: str) -> str:
    d = tmp("raw")
    os.makedirs(d)
    with open(os.path.join(d, "part-0"), "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_basic_and_no_final_separator(spark, tmp):
    p = _write(tmp, f"1{C}x{C}y{R}2{C}中文{C}😀")
    b = D.read_batch(spark, SPEC, path=p)
    assert _rows(b.rows) == [("1", "x", "y"), ("2", "中文", "😀")]
    assert b.rejected.count() == 0


def test_final_separator_gives_no_empty_record(spark, tmp):
    p = _write(tmp, f"1{C}x{C}y{R}")
    assert D.read_text_records(spark, p).count() == 1


def test_newline_is_data(spark, tmp):
    p = _write(tmp, f"1{C}x\ny{C}z\n{R}2{C}a{C}b{R}")
    rows = _rows(D.read_batch(spark, SPEC, path=p, mode="failfast").rows)
    assert rows == [("1", "x\ny", "z\n"), ("2", "a", "b")]


def test_trailing_empty_column(spark, tmp):
    p = _write(tmp, f"2{C}B{C}{R}")
    assert _rows(D.read_batch(spark, SPEC, path=p).rows) == [("2", "B", "")]
    with pytest.raises(Exception, match="fewer than 3 fields"):
        D.read_batch(spark, SPEC, path=p, mode="failfast").rows.collect()


def test_short_record(spark, tmp):
    p = _write(tmp, f"3{R}4{C}b{C}c{R}")
    b = D.read_batch(spark, SPEC, path=p)
    assert _rows(b.rows) == [("4", "b", "c")]
    assert _rows(b.rejected) == [("3", 1)]
    with pytest.raises(Exception, match="fewer than 3 fields"):
        D.read_batch(spark, SPEC, path=p, mode="failfast").rows.collect()


def test_extra_column_ignored(spark, tmp):
    p = _write(tmp, f"1{C}b{C}c{C}d{R}")
    assert _rows(D.read_batch(spark, SPEC, path=p, mode="failfast").rows) == [("1", "b", "c")]


def test_java_split_edge_cases(spark):
    df = spark.createDataFrame([("",), (C + C,), (f"{C}a",), (f"a{C}{C}",)], "value string")
    got = [r.p for r in df.select(D.split_record(F.col("value"), C, True).alias("p")).collect()]
    # Java: "" -> [""], separators only -> [], leading empty kept, trailing empties dropped.
    assert got == [[""], [], ["", "a"], ["a"]]


def test_regex_metachar_separator(spark, tmp):
    p = _write(tmp, "1|x|y\n")
    b = D.read_batch(spark, SPEC, path=p, record_sep="\n", col_sep="|")
    assert _rows(b.rows) == [("1", "x", "y")]


def test_export_roundtrip_and_nulls(spark, tmp):
    df = spark.createDataFrame([("1", None, "a\nb"), ("2", "", "中")], "a string, b string, c string")
    p = tmp("out")
    D.write_delimited(df, p)
    raw = "".join(open(os.path.join(p, f), encoding="utf-8").read() for f in sorted(os.listdir(p)) if f.startswith("part"))
    assert raw.count(R) == 2
    back = _rows(D.read_batch(spark, SPEC, path=p).rows)
    # A NULL cannot be written as delimited text: it reads back as ''.
    assert back == [("1", "", "a\nb"), ("2", "", "中")]


def test_export_refuses_separator_in_value(spark, tmp):
    df = spark.createDataFrame([("1", f"x{C}y", "z")], "a string, b string, c string")
    with pytest.raises(Exception, match="column separator"):
        D.write_delimited(df, tmp("bad"))
    df2 = spark.createDataFrame([("1", f"x{R}y", "z")], "a string, b string, c string")
    with pytest.raises(Exception, match="record separator"):
        D.write_delimited(df2, tmp("bad2"))


def _java_split(s: str, sep: str) -> list[str]:
    """Java String.split(literal, 0): split, then drop trailing empty strings;
    an input without any separator is returned whole (also when empty)."""
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_failfast_split_equals_java_split_on_random_records(spark):
    import random

    rnd = random.Random(11)
    atoms = [C, C, "", "a", "中", "😀", "\n", " ", "xy", "\x10x"[1:]]
    records = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, value string")
    got = dict(df.select("i", D.split_record(F.col("value"), C, True).alias("p")).collect())
    for i, r in enumerate(records):
        assert got[i] == _java_split(r, C), repr(r)
    # permissive keeps every field: exactly Python's split
    keep = dict(df.select("i", D.split_record(F.col("value"), C, False).alias("p")).collect())
    counts = dict(df.select("i", D.count_fields(F.col("value"), C).alias("n")).collect())
    for i, r in enumerate(records):
        assert keep[i] == r.split(C)
        assert counts[i] == len(r.split(C))
