"""A training corpus from ``documents``: quality rules, line dedup, near-dedup, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, lines, mixing, quality, simhash
from sluice.llm.common import stored

VOCABULARY = "byte_bpe_50k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose compression ratios lie in their bands.

    Null and empty texts have no words and go; texts of any length are judged whole. Repeated rows and
    rows with null ids are judged each alone; there are no ties. All columns come back, whatever
    their names; an empty table gives an empty one.
    """
    return quality.accepted(docs, rules=quality.Rules())


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of three lines or fifty words; ``n_chars``, where there is one,
    follows the text.

    A text with the lines of an earlier one loses them all and stays as an empty document; a null text
    keeps its ``n_chars``. The earliest copy by id (null first), text hash and line stays. Rows that
    repeat id and text are one document and stay alike. Texts are whole; an empty table gives an empty one.
    """
    kept = lines.deduplicated(docs, min_lines=3, min_words=50)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: shingles of three words, two bits apart at most.

    The smallest id stays, with all rows that repeat it; a null id only if its group has no other.
    Null and empty texts are one group, so one of them stays. Texts are whole, all columns come back,
    an empty table gives an empty one.
    """
    return simhash.one_of_each(docs, words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, twice at most.

    Null sources are a source of their own. Null and empty texts have no words to take and go. Repeated
    rows are drawn each alone; ties fall by a digest of id and text, so reruns agree. Texts are whole,
    all columns come back, an empty table gives an empty one.
    """
    return mixing.mixed(docs, preference=mixing.root)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and digests of them and of what they decode to.

    A null text has the tokens of an empty one, none. Each row is encoded alone and whole, so repeated
    ones come out alike; columns other than those named here are not returned. An empty table gives an
    empty one.
    """
    path = public_tokenizers.path(VOCABULARY)
    both = bpe.round_trip(docs, path, keep=["doc_id", "lang", "source"])
    return both.select("doc_id", "lang", "source", "ids", *bpe.digests())


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mix of sources", mix_sources),
    ("bpe", to_tokens),
]

#: SQL has neither zstandard, XXH64 with a seed nor BPE; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
