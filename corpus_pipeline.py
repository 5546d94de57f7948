"""A corpus-cleaning pipeline over ``documents``: five stages, each an operator of ``carestay.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread
as the next stage's documents. All but the last return the columns of documents, in their order, extra columns included
and unchanged whatever their names; an empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carestay.llm import bpe, decontaminate, linededup, simhash, toxicity
from carestay.llm.queries import default_vocabulary
from carestay.llm.store import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go.

    Rows are judged by their text alone, so repeated rows go or stay together; rows without doc_id are judged like any; null and
    empty texts have no toxic word and stay. Labels without doc_id or label teach nothing.
    """
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in an earlier document go; every document stays, if only with an empty text.

    Null texts stay null. Rows that repeat a doc_id count as one document and each stay; rows without doc_id neither own nor
    lose lines. Lines of one text that repeat within it stay.
    """
    return linededup.without_repeated_lines(docs, min_chars=10)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each near-duplicate group stays.

    Null and empty texts have fingerprint zero and form a group like any other. Of rows that repeat a doc_id the one of least text
    stays. Rows without doc_id all stay.
    """
    return simhash.drop_near_duplicates(docs, shingle_words=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Rows are judged by their text alone; null and empty texts, and rows without doc_id, stay unless hit. Items without
    item_id hit like any; items without words, or an empty benchmark, hit nothing.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), n=10, how="documents")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left.

    One row for each row, repeated ones and those without doc_id included; null counts as the empty text (no tokens).
    """
    return bpe.encode_digests(docs, default_vocabulary())


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash_dedup", dedup_documents),
          ("decontamination", drop_contaminated), ("bpe", encode)]

#: No SQL: character-model decoding, 64-bit simhash and BPE have none. tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
