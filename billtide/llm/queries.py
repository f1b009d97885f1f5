"""One query per operator over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from billtide.llm import (
    bpe,
    labelled,
    line_rules,
    merkle,
    mixing,
    near_vectors,
    notices,
    oracles,
    phrases,
    pii,
    quality_model,
    repeated_text,
    simhash,
    toxicity,
    wrappers,
)
from billtide.llm.rows import read
from billtide.session import written

TOKENIZER = "byte_bpe_50k.json"


def op1_repeated_text(spark, sf_dir):
    found = repeated_text.remove_repeated(read(spark, sf_dir, "documents", "doc_id", "text"))
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def scored(spark, sf_dir, label, folds, held_out, train, score, cut, *more):
    """Learns from one side of the folds and scores every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", label)
    model = train(*labelled.sample(docs, labels, label, folds, held_out))
    return score(docs, model).select(
        "doc_id",
        (labelled.remainder("doc_id", folds) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"),
        *more,
    )


def op2_quality_model(spark, sf_dir):
    return scored(
        spark, sf_dir, "quality", 3, 1, quality_model.train, quality_model.score_quality, 0.5
    )


def op8_toxicity(spark, sf_dir):
    # start:end of the sentences that score 0.3 or more, in code points
    located = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored(
        spark, sf_dir, "toxic", 4, 2, toxicity.train, toxicity.score_toxicity, 0.3, located.alias("offending")
    )


def op4_license_scan(spark, sf_dir):
    found = notices.scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op5_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op3_pii(spark, sf_dir):
    found = pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.spans_text(only_base=True), 256).alias("base_sha256"),
        pii.spans_text(only_base=False).alias("spans"),
    )


def op6_bpe(spark, sf_dir):
    path = public_tokenizers.path(TOKENIZER)
    return bpe.round_trip(read(spark, sf_dir, "documents", "doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_line_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return line_rules.clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "n_failed_lines", "lost_share",
    )


#: The sources' weights of the production mix; all others share the rest.
MIX = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.02}
MIX_OTHER = 0.58


def op9_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.shuffled(mixing.replicated(docs, MIX, MIX_OTHER)).select(
        "doc_id", "source", "copy", "place", "text"
    )


def op10_simhash(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    marked = written(simhash.fingerprints(docs).drop("text"), "simhash")
    return simhash.near_groups(marked).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op11_collocations(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op12_main_text(spark, sf_dir):
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return wrappers.extract(pages).select("page_id", "url", "text", "n_chars")


def op13_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", *merkle.FIELDS)
    moved = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    tampered = F.when(F.coalesce(moved, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(merkle.leaves(docs, n_chars=tampered)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_repeated_text": op1_repeated_text,
    "op2_quality_model": op2_quality_model,
    "op3_pii": op3_pii,
    "op4_license_scan": op4_license_scan,
    "op5_near_vectors": op5_near_vectors,
    "op6_bpe": op6_bpe,
    "op7_line_rules": op7_line_rules,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_main_text": op12_main_text,
    "op13_manifest": op13_manifest,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op1_repeated_text": oracles.OP1,
    "op5_near_vectors": oracles.OP5,
    "op7_line_rules": oracles.OP7,
    "op9_mixing": oracles.op9(MIX, MIX_OTHER),
    "op11_collocations": oracles.OP11,
    "op13_manifest": oracles.OP13,
}

if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
