"""The pipeline: each stage on its own input, and all of it."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from billtide.llm import bpe, line_rules
from tests.conftest import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def texts(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, awkward, nothing, name):
    docs = awkward.withColumn("Row_Key", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("a.b", F.lit(2))
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    assert STAGES[name](spark, nothing, SF).collect() == []
    out.collect()


def test_quality_stage(spark, awkward):
    out = {r.doc_id: r for r in STAGES["quality rules"](spark, awkward, SF).collect()}
    judged = {r.doc_id: r for r in line_rules.clean_lines(awkward).collect()}
    assert set(out) == {doc for doc, r in judged.items() if r.kept}
    assert all(out[doc].text == judged[doc].cleaned and out[doc].n_chars == len(out[doc].text) for doc in out)


def test_one_of_each_group_stays(spark, awkward):
    out = STAGES["simhash near-dedup"](spark, awkward, SF)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    groups = brute.near_texts(rows)
    assert sorted(r.doc_id for r in out.collect()) == sorted({least for _, least in groups.values()})


def test_no_ids_at_all(spark, awkward):
    docs = awkward.withColumn("doc_id", F.lit(None).cast("bigint")).where("text LIKE '%tail%' OR text = 'one'")
    assert len(STAGES["simhash near-dedup"](spark, docs, SF).collect()) == 2


def test_private_data_is_masked(spark, awkward):
    out = {r.doc_id: r.text for r in STAGES["personal data"](spark, awkward, SF).collect()}
    assert out[15].startswith("mail <EMAIL> or <IP>, card <CARD>, call <PHONE> now")
    assert out[8] == [r.text for r in awkward.where("doc_id = 8").collect()][0]


def test_last_stage(spark, awkward):
    own = bpe.token_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    for r in STAGES["bpe"](spark, awkward, SF).join(awkward.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.exact and r.n_tokens == len(r.ids) and b"".join(own[i] for i in r.ids).decode() == (r.text or "")


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    ours = sorted((r.doc_id, r.n_tokens, r.ids) for r in docs.collect())
    assert ours == sorted((r.doc_id, r.n_tokens, r.ids) for r in corpus_pipeline.run(spark, SF).collect())
    assert len(ours) > 50
