import os

import pytest

from saltkv.sources import spec as S

CONF = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "conf")


def test_parse_shipped_layouts():
    c = S.load_spec(os.path.join(CONF, "check.properties"))
    assert c.table_name == "check" and c.pre_regions == 3 and c.uniq_col == "id"
    assert c.query_key == ("check_id",)
    assert c.cols == ("id", "check_id", "rule_no", "rule_type", "rule_desc")
    assert c.column_index()["rule_desc"] == 4
    o = S.load_spec(os.path.join(CONF, "opinion.properties"))
    assert o.query_key == ("buss_no", "business_type")
    assert o.result_fields() == S.OPINION_FIELDS
    assert len(S.CHECK_FIELDS) == 18 and len(S.OPINION_FIELDS) == 19
    assert "opinin" in S.CHECK_FIELDS


def test_job_conf():
    conf = S.load_job_conf(os.path.join(CONF, "check.conf"))
    assert set(conf) == set(S.JOB_CONF_KEYS)
    assert S.load_job_conf("/nonexistent/x.conf") == {}


def test_properties_syntax():
    p = S.parse_properties("# c\n! c\n  a = 1\nb:2\ncols=x, y\n\n")
    assert p == {"a": "1", "b": "2", "cols": "x, y"}


def test_bad_specs():
    base = dict(tableName="t", namespace="n", uniqCol="id", preRegions="3", queryKey="k", cols="id,k")
    S.spec_from_properties(base)
    with pytest.raises(ValueError):
        S.spec_from_properties({**base, "cols": "id,k,k"})
    with pytest.raises(ValueError):
        S.spec_from_properties({**base, "queryKey": "zz"})
    with pytest.raises(ValueError):
        S.spec_from_properties({k: v for k, v in base.items() if k != "uniqCol"})
    with pytest.raises(ValueError):
        S.spec_from_properties({**base, "preRegions": "0"})
    with pytest.raises(FileNotFoundError):
        S.load_spec("/nonexistent/t.properties")


def test_hex_separators():
    assert S.hex_to_text("10") == "\x10"
    assert S.hex_to_text("01") == "\x01"


def test_separators_from_hex_properties():
    base = dict(tableName="t", namespace="n", uniqCol="id", preRegions="3", queryKey="k", cols="id,k")
    sp = S.spec_from_properties(base)
    assert (sp.record_sep, sp.col_sep) == ("\x10", "\x01")
    sp = S.spec_from_properties({**base, "recordSepHex": "0a", "colSepHex": "7c"})
    assert (sp.record_sep, sp.col_sep) == ("\n", "|")


def test_row_key_of_a_record(spark):
    from pyspark.sql import functions as F

    from saltkv.functions.keys import add_row_keys

    sp = S.load_spec(os.path.join(CONF, "opinion.properties"))
    parts = ["7-1", "7", "user", "text"]
    for n in (3, 10):
        df = spark.createDataFrame([tuple(parts)], sp.schema)
        want = add_row_keys(df, sp.query_key, sp.uniq_col, n).first().row_key
        assert sp.row_key_of(parts, n) == want
    assert sp.row_key_of(parts).startswith(str(sp.row_key_of(parts)[0]))
