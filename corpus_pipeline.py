"""A training corpus from raw documents: filter, deduplicate, replace personal data, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All but the
last return the columns of ``documents``. A document with a NULL id cannot be named by a
deduplication and always stays; rows that share id and text are one document, of which one stays;
different texts that share an id are different documents.
"""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.exact_dedup import exact_duplicates
from tillroll.llm.key_filter import broadcast_filter, possible
from tillroll.llm.near_dedup import near_duplicates
from tillroll.llm.packing import pack, token_pieces
from tillroll.llm.pii import replace_pii
from tillroll.llm.quality_rules import quality_rules
from tillroll.llm.shipping import ship_package
from tillroll.llm.staging import staged

# Surrogates are the same in every run with the same key; set your own for data that is shared.
PII_KEY = "surrogates of this corpus"
TOKENIZER = "word_bpe_49k.json"


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    judged, measures = quality_rules(docs, docs.columns)
    return judged.where(F.col(measures)["kept"]).select(*docs.columns)


def _split(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents whose ``doc_id`` may be in ``ids``, by a Bloom filter, and those that surely are not.

    Only the first, few of them beyond those that are, need a shuffle.
    """
    hashed = ids.select("doc_id", F.xxhash64("doc_id").alias("id_hash"))
    words = broadcast_filter(hashed, "id_hash")

    @F.pandas_udf("boolean")
    def listed(hashes: pd.Series) -> pd.Series:
        return pd.Series(possible(words.value, hashes.to_numpy()))

    doubtful = listed(F.xxhash64(F.col("doc_id").cast("long")))
    return docs.where(doubtful), docs.where(~doubtful)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose id is not in ``dropped``."""
    doubtful, kept = _split(docs, dropped)
    others = doubtful.join(dropped.hint("merge"), "doc_id", "left_anti")
    return kept.unionByName(others.select(*docs.columns))


_GIVEN_ID = "_given_id"


def _one_id_per_text(docs: DataFrame) -> DataFrame:
    """``docs`` with ids that no two different texts share; the given id goes to ``_given_id``.

    Ids with one text stay. Texts that share an id get new ones above all others, so that they count as
    documents of their own and come last where the least id decides.
    """
    known = docs.where("doc_id IS NOT NULL")
    texts = staged(known.select("doc_id", F.xxhash64("text").alias("text_hash")).distinct(), "id-texts")
    shared = texts.groupBy("doc_id").count().where("count > 1").select("doc_id")
    top = texts.agg(F.max("doc_id")).first()[0] or 0
    new_id = (F.monotonically_increasing_id() + F.lit(top + 1)).alias("new_id")
    renamed = staged(texts.join(shared, "doc_id", "left_semi").select("doc_id", "text_hash", new_id), "new-ids")
    given = docs.withColumn(_GIVEN_ID, F.col("doc_id"))
    if renamed.isEmpty():
        return given
    doubtful, others = _split(given, renamed.select("doc_id").distinct())
    told = doubtful.withColumn("text_hash", F.xxhash64("text")).join(renamed, ["doc_id", "text_hash"], "left")
    told = told.withColumn("doc_id", F.coalesce("new_id", "doc_id"))
    return staged(others.unionByName(told.select(*given.columns)), "one-id-per-text")


def _kept(docs: DataFrame, find) -> DataFrame:
    """The documents that a deduplication keeps."""
    single = _one_id_per_text(docs)
    verdicts = staged(find(single.select(*docs.columns)).select("doc_id", "kept"), "verdicts")
    left = _without(single, verdicts.where("NOT kept AND doc_id IS NOT NULL").select("doc_id"))
    repeated = verdicts.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    repeated = staged(repeated.select("doc_id"), "repeated")
    if not repeated.isEmpty():
        once = left.join(repeated, "doc_id", "left_semi").select(*left.columns).dropDuplicates(["doc_id"])
        left = _without(left, repeated).unionByName(once)
    return left.withColumn("doc_id", F.col(_GIVEN_ID)).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _kept(docs, exact_duplicates)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _kept(docs, near_duplicates)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return replace_pii(docs, PII_KEY).withColumn("n_chars", F.char_length("text").cast(kind))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack(token_pieces(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality rules", keep_clean),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("personal data", hide_personal_data),
    ("packing", pack_tokens),
]
# SQL expresses neither the surrogates nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if number == 0 else staged(docs, "stage"), sf_dir)
    return docs
