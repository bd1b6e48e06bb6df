"""The pipeline's stages against plain Python, each on its own input."""

import re
import subprocess
import sys

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as C
from conftest import ROOT, SF_MID
from saltkv.llm.common import written
from .test_decontam import shingles as item_shingles
from .test_decontam import words
from .test_ngram_join import brute as near_copies
from .test_pii import brute as personal_data


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = {"documents": docs}
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF_MID), f"test-{name}")
        out[name] = docs
    return out


def rows(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.select("doc_id", *cols).collect()}


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _ in C.STAGES] == list(stages)[1:] and len(C.STAGES) == 5
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_id_keeps_clean_documents(stages):
    before, after = rows(stages["documents"], "lang"), rows(stages["language_id"], "lang")
    assert set(after) <= set(before) and len(after) >= 0.995 * len(before)


def test_near_duplicates(stages):
    before, after = rows(stages["language_id"], "text"), rows(stages["near_duplicates"], "text")
    assert set(after) == {c for _, _, c in near_copies(sorted(before.items()))}


def test_decontamination(stages):
    items = [item_shingles(words(t)) for (t,) in duckdb.sql(f"select text from '{SF_MID}/benchmark.parquet'").fetchall()]
    before, after = rows(stages["near_duplicates"], "text"), rows(stages["decontamination"], "text")
    bad = {k for k, t in before.items() if any(len(s & item_shingles(words(t))) >= 0.8 * len(s) for s in items if s)}
    assert bad and set(after) == set(before) - bad


def test_personal_data(stages):
    before, after = rows(stages["decontamination"], "text"), rows(stages["personal_data"], "text")
    assert set(after) == set(before)
    changed = 0
    for k, t in before.items():
        spans = personal_data(t)
        changed += bool(spans)
        assert not any(t[a:b] in after[k] for a, b, _ in spans)
        if not spans:
            assert after[k] == t
        assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", after[k])) <= len(spans)
    assert changed > 10


def test_tokens(stages):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before = rows(stages["personal_data"], "text")
    got = rows(stages["tokens"], "ids", "round_trip")
    assert set(got) == set(before)
    for k, (ids, same) in got.items():
        assert same and np.frombuffer(ids, "<u2").tolist() == sp.encode(before[k])


def test_run_equals_its_stages(spark, stages):
    assert rows(C.run(spark, SF_MID), "ids_crc32") == rows(stages["tokens"], "ids_crc32")


def test_odd_rows_pass(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x", "en", "s", 1), (2, "", "en", "s", 0)], schema)
    for some in (docs, docs.limit(0)):
        df = some
        for name, stage in C.STAGES:
            df = written(stage(spark, df, SF_MID), f"odd-{name}")
        assert df.count() <= some.count()


def test_the_first_stage_judges_rows_not_ids(spark):
    real = spark.read.parquet(f"{SF_MID}/documents.parquet").where("lang = 'fr'").orderBy("doc_id").limit(40)
    first = real.orderBy("doc_id").first()
    none = real.limit(2).selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars")
    junk = spark.createDataFrame([(first.doc_id, "漢字漢字漢字漢字", None, first.source, 8), (None, "漢字漢字漢字漢字", None, first.source, 8)], real.schema)
    rare = spark.createDataFrame([(10**9, "zyx wvu tsr qpo nml kji hgf edc " * 20, "qq", "rare", 1)], real.schema)
    docs = real.unionByName(none).unionByName(junk).unionByName(rare)
    got = C.language_id(spark, docs, SF_MID)
    assert got.where("doc_id is null").count() == 2 and got.where(f"doc_id = {first.doc_id}").count() == 1
    assert got.where("text like '漢%'").count() == 0
    assert got.where("doc_id = 1000000000").count() == 1 and got.count() == 43  # a label of one row is a label
    for _, stage in C.STAGES[1:4]:
        got = written(stage(spark, got, SF_MID), "by-row")
    assert got.where("doc_id = 1000000000").count() == 1


def test_entry_works_without_the_subpackage(tmp_path):
    import shutil

    shutil.copytree(f"{ROOT}/saltkv", tmp_path / "saltkv", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'row_keys' in q and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
