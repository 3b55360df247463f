"""The pipeline on the smallest table: each stage against plain code over its own input."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from farelens.llm.secrets import mask, scan
from tests.llm.samples import odd_documents
from tests.llm.test_histogram_packing import check as check_packing
from tests.llm.test_simhash import components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_languages_keep_clean_documents(steps):
    assert rows(steps[1]) == rows(steps[0])


def test_one_of_each_group_stays(steps):
    prints = {}
    for r in steps[1].collect():
        prints.setdefault(plain_fingerprint(r.text), []).append(r.doc_id)
    root = components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for p, ids in prints.items():
        least.setdefault(root[p], []).extend(ids)
    kept = {min(ids) for ids in least.values()}
    assert rows(steps[2]) == [r for r in rows(steps[1]) if r[0] in kept]
    assert len(kept) < steps[1].count()


def test_secrets_are_masked(steps):
    expected, masked = [], 0
    for r in steps[2].collect():
        spans = scan(r.text)[1]
        text = mask(r.text, spans) if spans else r.text
        masked += bool(spans)
        expected.append((r.doc_id, text, r.lang, r.source, len(text) if spans else r.n_chars))
    assert rows(steps[3]) == sorted(expected, key=str)


def test_sample_is_part_of_its_input(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(after) <= set(before) and 0.3 * len(before) < len(after) <= len(before)


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [(r.doc_id, r.text) for r in steps[4].collect()]
    check_packing(tokenizer, docs, steps[5].collect(), 4096)


def test_run_gives_the_rows_of_the_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[5])


def test_odd_documents_pass_every_stage(spark, tmp_path):
    odd = odd_documents(spark)
    for name, docs in (("odd", odd), ("none", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = spark.read.parquet(f"{tmp_path}/{name}{k - 1 if k else ''}")
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}{k}")
        assert (spark.read.parquet(f"{tmp_path}/{name}{k}").count() > 0) == (name == "odd")
    once = spark.read.parquet(f"{tmp_path}/odd1").collect()
    assert len({plain_fingerprint(r.text) for r in once}) == len(once)
    assert np.isin([2, 3, 4], [r.doc_id for r in once]).sum() == 0
