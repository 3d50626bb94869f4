"""From documents to training tokens: quality, near duplicates, repeated passages, mixture, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import bpe, mixing, near_dup, quality, suffix_dedup
from beaconry.llm.common import load, prepare, stored
from beaconry.llm.queries import TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _only(docs: DataFrame, judged: DataFrame, names: dict[str, str]) -> DataFrame:
    """The rows of ``docs`` that are kept. Rows are told apart by id and text, not by id alone, and by the columns ``names`` (theirs: judged)."""
    gone = judged.where("NOT kept").select("doc_id", "text_hash", *names.values()).distinct()
    gone = gone.select(*(F.col(c).alias(f"gone_{c}") for c in gone.columns))
    same = F.col("doc_id").eqNullSafe(F.col("gone_doc_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone_text_hash"))
    for theirs, name in names.items():
        same &= F.col(theirs).eqNullSafe(F.col(f"gone_{name}"))
    return docs.select(*COLUMNS).join(gone, same, "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half.

    Rows are judged one by one, repeated ids and null ids too; null texts as empty ones, long ones whole; null sources and languages
    are sites of their own; an empty table stays empty; other columns go.
    """
    judged = quality.quality_classifier(docs, load(spark, sf_dir, "labels"), with_row=True)
    return _only(docs, judged, {"source": "host", "lang": "path"})


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every group of near duplicates (five words a shingle, similarity 0.8).

    Equal rows become one. Of texts that share an id each is judged by itself. Null and empty texts, and rows without id, are
    duplicates of nothing; long texts are compared whole; an empty table stays empty; other columns go.
    """
    return _only(docs, near_dup.near_duplicates(docs, size=5, share=80, with_hash=True), {}).dropDuplicates(COLUMNS)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes and more that also start earlier; a text of which nothing is left goes.

    Null texts come back empty. Rows without id stay whole; texts that share an id are documents of their own, equal rows are one and each
    stay; long texts are searched whole; an empty table stays empty; other columns go.
    """
    left = suffix_dedup.suffix_dedup(docs, window=100, with_text=True, carry=["lang", "source"])
    return (left.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in which every source is passed through at least once and none more than twice as often as another: passes repeat rows.

    A null source is a source of its own; null, empty and long texts, null and repeated ids are rows like others; an empty table stays
    empty; other columns go.
    """
    return mixing.mix(docs, repeats=2.0, keep=COLUMNS).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the text decoded from them.

    Null texts have no ids, like empty ones; long texts are encoded whole; null and repeated ids are rows like others; an empty table stays
    empty; other columns go.
    """
    path = public_tokenizers.path(TOKENIZER)
    return bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("suffix-array dedup", suffix_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", bpe_stage),
]

# A fitted classifier and set-similarity components have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
