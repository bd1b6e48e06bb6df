import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from saltkv.operators import cells as C
from saltkv.plans import fixtures as FX
from saltkv.sources.spec import CHECK_FIELDS
from conftest import SF_SMALL


def test_roundtrip_is_identity(spark):
    t = E.check_table(spark, SF_SMALL)
    back = C.from_cells(C.to_cells(t, FX.CHECK.cols), FX.CHECK.cols)
    a = sorted(tuple(r) for r in back.collect())
    b = sorted(tuple(r) for r in t.select("row_key", *FX.CHECK.cols).collect())
    assert a == b


def test_null_is_no_cell_empty_is_a_cell(spark):
    df = spark.createDataFrame([("k1", None, ""), ("k2", "x", None)], "row_key string, a string, b string")
    cells = sorted(tuple(r) for r in C.to_cells(df, ["a", "b"], "f").collect())
    assert cells == [("k1", "f", "b", ""), ("k2", "f", "a", "x")]
    back = {r.row_key: r for r in C.from_cells(C.to_cells(df, ["a", "b"]), ["a", "b", "c"]).collect()}
    assert (back["k1"].a, back["k1"].b, back["k1"].c) == (None, "", None)


def test_unknown_qualifier_fails(spark):
    cells = spark.createDataFrame([("k", "f", "zzz", "v")], "row_key string, family string, qualifier string, value string")
    with pytest.raises(Exception, match="no field for stored column zzz"):
        C.from_cells(cells, CHECK_FIELDS).collect()
    assert C.from_cells(cells, CHECK_FIELDS, strict=False).count() == 1


def test_versioned_cells(spark):
    cells = spark.createDataFrame(
        [("k", 1, "f", "a", "old"), ("k", 2, "f", "a", "new"), ("k", 1, "f", "b", "keep")],
        "row_key string, load_ts long, family string, qualifier string, value string",
    )
    r = C.from_cells(cells, ["a", "b"], version="load_ts").first()
    assert (r.a, r.b) == ("new", "keep")


def test_family_filter_and_binary(spark):
    t = E.check_table(spark, SF_SMALL)
    cells = C.to_cells(t, FX.CHECK.cols, "f")
    assert C.from_cells(cells, FX.CHECK.cols, family="g").count() == 0
    b = C.to_binary_cells(cells)
    assert dict(b.dtypes)["value"] == "binary"
    assert sorted(map(tuple, C.from_binary_cells(b).collect())) == sorted(map(tuple, cells.select("row_key", "family", "qualifier", "value").collect()))
