"""A corpus pipeline of five stages over ``documents``: rules, near-dedup, substring dedup, mixing, encoding.

Each stage is (name, function); a function takes (spark, docs, sf_dir), its result is written
as Parquet and read again as the next one's docs. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import byte_bpe, mixing, near_copies, quality_rules, substring
from quern.plans.scratch import release, stored
from quern.sources.tables import table

#: Differing bits of distinct-word fingerprints that make a candidate; bands of minimum digests add those it misses (see the README).
NEAR_BITS = 4


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: exact Jaccard of five-word shingles, 0.8 or more."""
    return near_copies.one_of_each(docs, limit=NEAR_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without repeated passages; n_chars is that of the new text."""
    out = substring.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document that is left."""
    ids = byte_bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(*done)
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: Components of near copies and merge replay are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None
