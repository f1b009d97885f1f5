"""From raw documents to shuffled token ids: one stage per operator, each written before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billtide.llm import bpe, line_rules, mixing, pii, simhash
from billtide.llm.rows import quoted, small_batches
from billtide.session import written

TOKENIZER = "byte_bpe_50k.json"
#: Shares of the sources in the mix, and of all others together.
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1}
OTHER = 0.6
#: Tokenisation, Poisson counts and vantage points have no SQL form.
ORACLE_SQL = None
#: Equal for rows with equal id and text.
ROW_KEY = "sha2(concat(coalesce(cast(doc_id AS string), 'null'), ':', coalesce(text, '')), 256)"


def aside(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as ``d``: no operator's result can clash with them."""
    others = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("d"), "text")


def with_text(df: DataFrame, made: str, columns: list[str]) -> DataFrame:
    """``columns`` out of ``d``, the text replaced by the column ``made`` and counted anew."""
    changed = {"text": F.col(made), "n_chars": F.char_length(made).cast("bigint")}
    return df.select(*[changed.get(c, F.col(f"d.{quoted(c)}")).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines; documents that lose too much, or fail the counts, go."""
    small_batches(spark)
    judged = line_rules.clean_lines(aside(docs))
    return with_text(judged.where("kept"), "cleaned", docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id.

    Among rows that share this id it is the one with the smallest hash of its text, once if repeated.
    """
    small_batches(spark)
    marked = simhash.fingerprints(docs.select("doc_id", "text", F.expr(ROW_KEY).alias("row_key")))
    groups = simhash.near_groups(written(marked.select("doc_id", "row_key", "fp"), "simhash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key"))
    kept = groups.groupBy("group_fp").agg(first.alias("first")).select("first.row_key")
    held = docs.select(F.expr(ROW_KEY).alias("row_key"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("d"))
    return held.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select("d.*")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    small_batches(spark)
    return with_text(pii.find_pii(aside(docs)), "masked", docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources have their shares, in one global random order."""
    return mixing.shuffled(mixing.replicated(docs, WEIGHTS, OTHER)).select(*map(quoted, docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether decoding gives the text back."""
    small_batches(spark)
    path = public_tokenizers.path(TOKENIZER)
    return bpe.round_trip(docs.select("doc_id", "source", "text"), path).select(
        "doc_id", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("personal data", private_data),
    ("mixing sources", mixed),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
    return docs
