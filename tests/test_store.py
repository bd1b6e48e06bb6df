import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from saltkv.operators.lookup import lookup
from saltkv.plans import fixtures as FX
from saltkv.plans.inspect import partition_filters, plan_text, pushed_filters
from saltkv.plans.job import load_rows
from saltkv.sources import merged as MG
from saltkv.sources import store as ST
from conftest import SF_SMALL, local_path

COLS = [*FX.CHECK.cols, "remarks"]


@pytest.fixture(scope="module")
def three(spark):
    root = E.scratch_path(spark, "store3")
    for i, d in enumerate(FX.check_loads(spark, SF_SMALL, 3)):
        load_rows(spark, FX.CHECK, d, root, load_ts=i + 1)
    return ST.table_location(FX.CHECK, root)


def test_publish_is_one_rename(spark, tmp):
    root = tmp("store")
    df = FX.check_rows(spark, SF_SMALL)
    res = load_rows(spark, FX.CHECK, df, root, load_ts=42)
    assert res.load_dir.endswith("load_ts=42")
    assert ST.list_loads(spark, res.table_dir) == [42]
    salts = sorted(os.listdir(local_path(res.load_dir)))
    assert [s for s in salts if s.startswith("salt=")] == ["salt=0", "salt=1", "salt=2"]
    with pytest.raises(FileExistsError):
        load_rows(spark, FX.CHECK, df, root, load_ts=42)


def test_single_load_read_skips_merge(spark, tmp):
    res = load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), tmp("s1"), load_ts=1)
    cur = ST.current(spark, res.table_dir, FX.CHECK.cols)
    assert "Exchange" not in plan_text(cur)
    assert cur.count() == FX.check_rows(spark, SF_SMALL).count()


def test_latest_wins_semantics(spark, three):
    cur = {r.id: r for r in ST.current(spark, three, COLS).collect()}
    base = {r.id: r for r in FX.check_rows(spark, SF_SMALL).collect()}
    assert len(cur) == len(base)
    for i, b in base.items():
        k = int(i)
        r = cur[i]
        assert r.rule_no == b.rule_no  # never rewritten
        if k % 3 == 0:
            assert r.rule_type == b.rule_type.lower() + "2"
            # '' replaces, NULL keeps the older value
            assert r.rule_desc == ("" if k % 2 == 0 else b.rule_desc)
        else:
            assert (r.rule_type, r.rule_desc) == (b.rule_type, b.rule_desc)
        assert r.remarks == (f"r{i}" if k % 5 == 0 else None)
        assert r.load_ts == max([1] + [2] * (k % 3 == 0) + [3] * (k % 5 == 0))


def test_as_of(spark, three):
    first = ST.current(spark, three, COLS, as_of=1)
    assert first.where(F.col("remarks").isNotNull()).count() == 0
    assert first.where(F.col("rule_type").endswith("2")).count() == 0


def test_same_batch_twice_changes_nothing(spark, tmp):
    root = tmp("twice")
    df = FX.check_rows(spark, SF_SMALL)
    load_rows(spark, FX.CHECK, df, root, load_ts=1)
    d = ST.table_location(FX.CHECK, root)
    once = sorted(tuple(r) for r in ST.current(spark, d, FX.CHECK.cols).drop("load_ts").collect())
    load_rows(spark, FX.CHECK, df, root, load_ts=2)
    twice = sorted(tuple(r) for r in ST.current(spark, d, FX.CHECK.cols).drop("load_ts").collect())
    assert once == twice


def test_lookup_prunes_salt_and_pushes_prefix(spark, three):
    cur = ST.current(spark, three, COLS)
    hot = E._top_key(FX.check_rows(spark, SF_SMALL), ["check_id"])["check_id"]
    q = lookup(cur, FX.CHECK, hot, COLS)
    pf = " ".join(partition_filters(q))
    assert "salt" in pf
    assert any("prefix" in p for p in pushed_filters(q))
    # The filter is applied below the merge aggregate, at the scan.
    n = FX.check_rows(spark, SF_SMALL).where(F.col("check_id") == hot).count()
    assert n > 0 and q.count() == n


def test_catalog_table_and_listing(spark, tmp, three):
    ns = "ns_test_listing"
    ST.create_table(spark, FX.CHECK.with_(namespace=ns, table_name="check3"), three, COLS, namespace_location=tmp("ns"))
    names = [r.qualified_name for r in ST.list_tables(spark, ns).collect()]
    assert names == [f"{ns}:check3"]
    assert ST.list_tables_text(spark, ns) == f"{ns}:check3"
    assert ST.list_tables_text(spark, "no_such_namespace_x") == "get table list error"
    n = spark.sql(f"SELECT count(*) AS n FROM {ns}.check3").first().n
    assert n == ST.read_loads(spark, three, COLS).count()


def test_bloom_filter_option(spark, tmp):
    opts = ST.write_options(bloom_filter=True, expected_keys=1000)
    assert opts["parquet.bloom.filter.enabled#prefix"] == "true"
    res = load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), tmp("bloom"), load_ts=5, bloom_filter=True)
    assert ST.current(spark, res.table_dir, FX.CHECK.cols).count() > 0


def test_batch_lookup_merges_only_requested_keys(spark, three):
    from saltkv.operators.lookup import batch_lookup

    cur = ST.current(spark, three, COLS)
    reqs = spark.createDataFrame([("a", "10"), ("b", "11")], "req_id string, check_id string")
    q = batch_lookup(cur, FX.CHECK, reqs, fields=COLS)
    txt = plan_text(q)
    # The semi join sits under the merge aggregate, right above the scan.
    agg_at = txt.find("SortAggregate")
    semi_at = txt.find("LeftSemi")
    assert 0 <= agg_at < semi_at


def test_the_merged_copy_equals_the_merge(spark, tmp):
    root = tmp("merged")
    loads = FX.check_loads(spark, SF_SMALL, 3)
    # Load 1 is written without the remarks column at all.
    res = load_rows(spark, FX.CHECK, loads[0].drop("remarks"), root, load_ts=1)
    load_rows(spark, FX.CHECK, loads[1], root, load_ts=2)
    d = res.table_dir
    MG.upsert_loads(spark, FX.CHECK, d)
    copy = MG.merged(spark, d, COLS)
    assert "Exchange" not in plan_text(copy)  # nothing to merge
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, ST.current(spark, d, COLS).collect()))
    load_rows(spark, FX.CHECK, loads[2], root, load_ts=3, upsert=True)
    want = sorted(map(tuple, ST.current(spark, d, COLS).collect()))
    assert sorted(map(tuple, MG.merged(spark, d, COLS).collect())) == want
    MG.upsert_loads(spark, FX.CHECK, d, [2, 1])  # again, and out of order
    assert sorted(map(tuple, MG.merged(spark, d, COLS).collect())) == want
    MG.upsert_loads(spark, FX.CHECK, d, rebuild=True)
    assert sorted(map(tuple, MG.merged(spark, d, COLS).collect())) == want


def test_an_upsert_rewrites_only_touched_partitions(spark, tmp):
    import glob
    import os

    root = tmp("touched")
    base = FX.check_rows(spark, SF_SMALL)
    d = load_rows(spark, FX.CHECK, base, root, load_ts=1, upsert=True).table_dir
    files = lambda: set(glob.glob(f"{local_path(MG.merged_dir(d))}/salt=*/slice=*/*.parquet"))
    before = files()
    one = base.orderBy("id").limit(1).withColumn("rule_no", F.lit("new"))
    load_rows(spark, FX.CHECK, one, root, load_ts=2)
    touched = MG.upsert_loads(spark, FX.CHECK, d, [2])
    assert len(touched) == 1
    changed = {os.path.dirname(f) for f in before ^ files()}
    assert len(changed) == 1 and changed.pop().endswith(touched[0])
    assert MG.merged(spark, d, COLS).where("rule_no = 'new'").count() == 1
    # salt and prefix prune the copy like the table itself
    from saltkv.operators.lookup import lookup
    key = base.first().check_id
    got = lookup(MG.merged(spark, d, FX.CHECK.cols), FX.CHECK, key, FX.CHECK.cols)
    assert "salt" in partition_filters(got)[0]


def test_published_files_sorted_one_salt_and_staging_gone(spark, tmp):
    import glob

    import pyarrow.parquet as pq

    root = tmp("files")
    res = load_rows(spark, FX.CHECK, FX.check_rows(spark, "/root/testdata/sf0.01"), root, load_ts=9, files_per_bucket=3)
    files = sorted(glob.glob(os.path.join(local_path(res.load_dir), "salt=*", "*.parquet")))
    assert len(files) >= 6
    for f in files:
        keys = pq.read_table(f, columns=["row_key"]).column("row_key").to_pylist()
        assert keys == sorted(keys, key=lambda k: k.encode())
        assert {k[0] for k in keys} == {f.split("salt=")[1][0]}
    staging = os.path.join(local_path(res.table_dir), "_staging")
    assert os.path.isdir(staging) and os.listdir(staging) == []


def test_files_follow_input_size(spark):
    from saltkv.operators.layout import TARGET_INPUT_BYTES_PER_FILE, files_per_bucket_for

    assert files_per_bucket_for(spark, 3, 0) == 1
    assert files_per_bucket_for(spark, 3, 10 * TARGET_INPUT_BYTES_PER_FILE) == 4
    assert files_per_bucket_for(spark, 3) == 3  # 8 shuffle partitions in tests


def test_latest_wins_matches_python_model(spark):
    """Property: per row key and column, the newest non-NULL value wins
    ('' is a value); ties inside one version resolve to the larger value."""
    import random

    from saltkv.operators.merge import latest_wins

    rnd = random.Random(5)
    vals = [None, None, "", "a", "b", "c"]
    rows = []
    for _ in range(600):
        rows.append((f"k{rnd.randint(0, 40)}", rnd.randint(1, 5), rnd.choice(vals), rnd.choice(vals)))
    df = spark.createDataFrame(rows, "row_key string, load_ts long, x string, y string")
    df = df.withColumn("salt", F.lit(0)).withColumn("prefix", F.col("row_key"))
    got = {r.row_key: (r.x, r.y, r.load_ts) for r in latest_wins(df, ["x", "y"]).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        def pick(i):
            cands = [(r[1], r[i]) for r in mine if r[i] is not None]
            return max(cands)[1] if cands else None
        want[key] = (pick(2), pick(3), max(r[1] for r in mine))
    assert got == want


def test_reloading_an_older_batch_date_wins(spark, tmp):
    """D13: versions are load times, not batch dates."""
    from saltkv.plans.job import load_batch
    from saltkv.sources import delimited as D

    inp = tmp("dates")
    spec = FX.CHECK.with_(input_path_prefix=inp)
    row = lambda v: spark.createDataFrame([("1", "k", "r", v, "d")], ",".join(f"{c} string" for c in FX.CHECK.cols))
    D.write_delimited(row("newer-date"), f"{inp}/2024-01-02")
    D.write_delimited(row("older-date"), f"{inp}/2024-01-01")
    root = tmp("dates-store")
    load_batch(spark, spec, "2024-01-02", root)          # wall-clock load_ts
    res = load_batch(spark, spec, "2024-01-01", root)    # later wall clock, older date
    cur = ST.current(spark, res.table_dir, FX.CHECK.cols).first()
    assert cur.rule_type == "older-date"


def test_whole_row_merge_equals_column_merge_when_loads_write_everything(spark):
    from saltkv.operators.merge import latest_row_wins, latest_wins

    base = E.check_table(spark, SF_SMALL)
    k = F.col("id").cast("long")
    v1 = base.withColumn("load_ts", F.lit(1).cast("long"))
    v2 = base.where(k % 2 == 0).withColumn("rule_type", F.lit("changed")).withColumn("load_ts", F.lit(2).cast("long"))
    loads = v1.unionByName(v2)
    cols = list(FX.CHECK.cols)
    a = sorted(map(tuple, latest_wins(loads, cols).select("row_key", *cols, "load_ts").collect()))
    b = sorted(map(tuple, latest_row_wins(loads).select("row_key", *cols, "load_ts").collect()))
    assert a == b


def test_refresh_table_picks_up_new_loads(spark, tmp):
    root = tmp("refresh")
    res = load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), root, load_ts=1)
    spec = FX.CHECK.with_(namespace="ns_refresh")
    ST.create_table(spark, spec, res.table_dir, namespace_location=tmp("nsr"))
    n1 = spark.table("ns_refresh.check").count()
    load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), root, load_ts=2)
    ST.refresh_table(spark, spec)
    assert spark.table("ns_refresh.check").count() == 2 * n1
    # a load of a registered table refreshes the catalog itself
    assert ST.registered_at(spark, spec, res.table_dir)
    assert not ST.registered_at(spark, spec, res.table_dir + "-elsewhere")
    load_rows(spark, spec.with_(table_path=res.table_dir), FX.check_rows(spark, SF_SMALL), None, load_ts=3)
    assert spark.table("ns_refresh.check").count() == 3 * n1


def test_sql_current_view(spark, tmp, three):
    from saltkv.functions.keys import prefix_py

    spec = FX.CHECK.with_(namespace="ns_view", table_name="check3v")
    ST.create_table(spark, spec, three, COLS, namespace_location=tmp("nsv"))
    view = ST.create_current_view(spark, spec, COLS)
    want = sorted(map(tuple, ST.current(spark, three, COLS).select("row_key", *COLS, "load_ts").collect()))
    got = sorted(map(tuple, spark.sql(f"SELECT row_key, {', '.join(COLS)}, load_ts FROM {view}").collect()))
    assert got == want
    s, p = prefix_py("10", 3)
    q = spark.sql(f"SELECT * FROM {view} WHERE salt = {s} AND prefix = '{p}'")
    assert "salt" in " ".join(partition_filters(q))
    assert any("prefix" in f for f in pushed_filters(q))


def test_text_loads_merge_whole_rows(spark, tmp):
    """Loads from delimited text are NULL-free with unique keys: the manifest
    lets the reader use one whole-row aggregate, with the same result."""
    from saltkv.operators.merge import latest_wins
    from saltkv.plans.job import load_batch
    from saltkv.sources import delimited as D

    inp = tmp("wr-in")
    base = FX.check_rows(spark, SF_SMALL)
    k = F.col("id").cast("long")
    D.write_delimited(base, f"{inp}/d1")
    D.write_delimited(base.where(k % 2 == 0).withColumn("rule_type", F.lit("")), f"{inp}/d2")
    spec = FX.CHECK.with_(input_path_prefix=inp)
    root = tmp("wr-store")
    load_batch(spark, spec, "d1", root, load_ts=1)
    res = load_batch(spark, spec, "d2", root, load_ts=2)
    m = ST.read_manifest(spark, res.load_dir)
    assert m.pop("loaded") == res.n_loaded > 0 and m == {"columns": list(FX.CHECK.cols), "nulls": False, "unique": True}
    cur = ST.current(spark, res.table_dir, FX.CHECK.cols)
    txt = plan_text(cur)
    assert "CASE WHEN isnotnull" not in txt and "max(struct(" in txt  # one whole-row aggregate
    ref = latest_wins(ST.read_loads(spark, res.table_dir, FX.CHECK.cols), list(FX.CHECK.cols))
    assert sorted(map(tuple, cur.collect())) == sorted(map(tuple, ref.collect()))
    # A DataFrame load may hold NULLs: back to the per-column merge.
    load_rows(spark, FX.CHECK, base, root, load_ts=3)
    assert plan_text(ST.current(spark, res.table_dir, FX.CHECK.cols)).count("CASE WHEN isnotnull") > 0


def test_upsert_keeps_columns_of_older_loads(spark, tmp):
    root = tmp("auto-cols")
    base = FX.check_rows(spark, SF_SMALL)
    load_rows(spark, FX.CHECK, base.withColumn("remarks", F.lit("old")), root, load_ts=1, upsert=True)
    res = load_rows(spark, FX.CHECK, base, root, load_ts=2, upsert=True)
    assert ST.table_columns(spark, res.table_dir) == [*FX.CHECK.cols, "remarks"]
    cur = MG.merged(spark, res.table_dir)
    assert cur.columns == ST.current(spark, res.table_dir).columns
    assert {(r.remarks, r.load_ts) for r in cur.collect()} == {("old", 2)}


def test_first_rows_merges_only_candidates(spark, tmp, three):
    want = [tuple(r) for r in ST.current(spark, three, COLS).orderBy("row_key").limit(7).collect()]
    q = ST.first_rows(spark, three, 7, COLS)
    assert [tuple(r) for r in q.collect()] == want
    txt = plan_text(q)
    assert 0 <= txt.find("SortAggregate") < txt.find("LeftSemi")


def test_batch_lookup_without_broadcast_on_merged_table(spark, three):
    from saltkv.operators.lookup import batch_lookup

    cur = ST.current(spark, three, COLS)
    reqs = FX.check_rows(spark, SF_SMALL).select(F.concat(F.lit("r"), "id").alias("req_id"), "check_id")
    a = sorted(map(tuple, batch_lookup(cur, FX.CHECK, reqs, fields=COLS).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no broadcast anywhere
    try:
        q = batch_lookup(cur, FX.CHECK, reqs, fields=COLS)
        assert "BroadcastHashJoin" not in plan_text(q)
        assert sorted(map(tuple, q.collect())) == a and a
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ------------------------------------------------------------ loads out of order, repeated keys


def _rows(spark, *rows, cols=("id", "check_id", "rule_no")):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in cols))


def _small(**kw):
    return FX.CHECK.with_(cols=("id", "check_id", "rule_no"), **kw)


def _load(spark, root, rows, **kw):
    from saltkv.plans.job import load_rows

    return load_rows(spark, _small(), rows, root, **kw)


def test_a_late_load_is_merged(spark, tmp):
    root = tmp("late")
    d = _load(spark, root, _rows(spark, ("1", "a", "one"), ("2", "b", "one")), load_ts=1, upsert=True).table_dir
    _load(spark, root, _rows(spark, ("1", "a", "five")), load_ts=5, upsert=True)
    _load(spark, root, _rows(spark, ("1", "a", "three"), ("3", "c", "three"), ("2", "b", "")), load_ts=3, upsert=True)
    read = lambda df: sorted((r.id, r.rule_no, r.load_ts) for r in df.collect())
    want = [("1", "five", 5), ("2", "", 3), ("3", "three", 3)]
    assert read(MG.merged(spark, d)) == want == read(ST.current(spark, d))


def test_loads_count_themselves(spark, tmp):
    res = _load(spark, tmp("counts"), _rows(spark, ("1", "a", "x"), ("1", "a", "x"), ("2", "a", "x")), load_ts=1)
    assert res.n_loaded == 2 and ST.read_manifest(spark, res.load_dir)["loaded"] == 2
    empty = _load(spark, tmp("counts0"), spark.createDataFrame([], "id string, check_id string, rule_no string"), load_ts=1)
    assert empty.n_loaded == 0


def test_a_claimed_version_is_not_published_twice(spark, tmp):
    root = tmp("claims")
    d = _load(spark, root, _rows(spark, ("1", "a", "x")), load_ts=1).table_dir
    assert ST.claim_version(spark, d, 7, "another writer")
    with pytest.raises(FileExistsError):
        _load(spark, root, _rows(spark, ("2", "a", "x")), load_ts=7)
    assert ST.list_loads(spark, d) == [1] and not ST.claim_version(spark, d, 1, "x")


def test_repeated_keys_merge_whatever_the_number_of_loads(spark, tmp):
    root = tmp("dups")
    rows = [(str(i % 7), "k", f"v{i:02d}") for i in range(16)]
    want = {str(k): max(r[2] for r in rows if r[0] == str(k)) for k in range(7)}
    d = _load(spark, root, _rows(spark, *rows), load_ts=1, dedup=False).table_dir
    read = lambda df: sorted((r.id, r.rule_no) for r in df.collect())
    for _ in range(2):
        assert read(ST.current(spark, d)) == sorted(want.items())
        first = sorted(ST.current(spark, d).collect(), key=lambda r: r.row_key)[:4]
        assert [r.row_key for r in ST.first_rows(spark, d, 4).collect()] == [r.row_key for r in first]
        if ST.list_loads(spark, d) == [1]:
            _load(spark, root, _rows(spark, *rows), load_ts=2, dedup=False)
    MG.upsert_loads(spark, _small(), d)
    assert read(MG.merged(spark, d)) == sorted(want.items())


def test_two_loads_in_one_millisecond(spark, tmp, monkeypatch):
    root = tmp("clock")
    monkeypatch.setattr(ST, "new_load_ts", lambda: 77)
    a = _load(spark, root, _rows(spark, ("1", "a", "x")))
    b = _load(spark, root, _rows(spark, ("2", "a", "x")))
    assert (a.load_ts, b.load_ts) == (77, 78) and ST.current(spark, a.table_dir).count() == 2


def test_a_table_registered_elsewhere_is_registered_anew(spark, tmp):
    spec = _small(namespace="keyspace_moved", table_name="t")
    from saltkv.plans.job import load_rows

    for i, root in enumerate((tmp("place-a"), tmp("place-b"))):
        d = load_rows(spark, spec, _rows(spark, *[(str(k), "a", "x") for k in range(i + 1)]), root, load_ts=1).table_dir
        ST.create_table(spark, spec, d, namespace_location=tmp("ns-moved"))
        assert spark.table("keyspace_moved.t").count() == i + 1
    ST.create_current_view(spark, spec)
    load_rows(spark, spec, _rows(spark, ("9", "a", "x", "new"), cols=("id", "check_id", "rule_no", "remarks")), root, load_ts=2)
    assert {r.remarks for r in spark.sql("SELECT remarks FROM keyspace_moved.t_current").collect()} == {None, "new"}


def test_nth_key_beyond_many_copies(spark):
    raw = spark.createDataFrame([("a",)] * 50 + [("b",)] * 3 + [("c",)] * 40 + [("d",)], "row_key string")
    for copies in (1, 4, 100):
        assert [ST._nth_key(raw, n, copies, 2) for n in (1, 2, 3, 4, 5)] == ["a", "b", "c", "d", None]


def test_a_load_of_many_rows_gets_more_files_than_asked(spark, tmp, monkeypatch):
    from saltkv.plans.job import load_rows
    from saltkv.sources import sketches as SK

    monkeypatch.setattr(SK, "MOST_ROWS_PER_FILE", 100)
    rows = FX.check_rows(spark, "/root/testdata/sf0.001")
    root = tmp("many")
    res = load_rows(spark, FX.CHECK, rows, root, load_ts=1, bloom_filter=True, files_per_bucket=1)
    d = res.load_dir.removeprefix("file:")
    files = [f for _, _, fs in os.walk(d) for f in fs if f.endswith(".parquet")]
    assert len(files) - 1 > 2 * FX.CHECK.pre_regions  # and the sketches' file


def test_a_task_of_the_load_job_gets_little_text(spark):
    from saltkv.operators.layout import files_per_bucket_for

    assert 3 * files_per_bucket_for(spark, 3, 3 << 30) >= 36  # keyed rows take several times their text in memory


def test_an_upsert_moves_rows_once(spark):
    from saltkv.sources.merged import folded_in_ranges

    rows = [("a", 1, "0p", "0pk1", 1), (None, None, "0p", "0pk1", 2), ("b", 2, "0p", "0pk1", 2), ("c", 1, "0q", "0qk2", 1), ("d", 1, None, "1x", 1)]
    df = spark.createDataFrame(rows * 3, "c string, c__v long, prefix string, row_key string, load_ts long")
    df = df.withColumn("salt", F.substring("row_key", 1, 1).cast("int")).withColumn("slice", F.lit("h"))
    laid = folded_in_ranges(df, ["c"], 4)
    assert laid._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    own = laid.withColumn("part", F.spark_partition_id()).collect()
    assert sorted((r.c, r.c__v, r.prefix, r.row_key, r.load_ts) for r in own if r.prefix) == [("b", 2, "0p", "0pk1", 2), ("c", 1, "0q", "0qk2", 1)]
    assert len(own) == 3
    for part in {r.part for r in own}:
        keys = [(r.salt, r.row_key) for r in own if r.part == part]
        assert keys == sorted(keys)
