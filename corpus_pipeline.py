"""The corpus pipeline: five stages over ``documents``, each written and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept. The first four return the columns of ``docs``; the last gives the token
ids, their source spans and the decoded text of each document that is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spanpack.llm import decontam, pieces, simhash, suffixes, toxicity
from spanpack.llm.common import shared_folder, table
from spanpack.llm.queries import tokenizer_path, toxicity_grammar


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores 0.5 or more go."""
    return toxicity.drop_toxic(docs, toxicity_grammar(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one with
    the smallest id (three-word shingles, at most two bits apart). Rows that
    repeat an id with an unrelated text stay."""
    return simhash.drop_near_duplicates(docs, words=3, radius=2, ids_once=False)


#: What a passage of 51 words takes at least: 99 of 100 such runs of words in the
#: given documents are longer than this in every language but English (98).
PASSAGE_BYTES = 250


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text in strings of ``PASSAGE_BYTES`` that occur more than once is cut out,
    at whole characters, so passages of over 50 words that repeat go; documents
    stay, with ``n_chars`` counted anew."""
    return suffixes.cut_texts(docs, length=PASSAGE_BYTES, anchor=PASSAGE_BYTES // 2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, begins, ends, decoded)`` of every document that is left."""
    return pieces.encode(docs, pieces.model_bytes(tokenizer_path()), decoded=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]

#: No stage but the first could be said in SQL, and that one is learned.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result goes to Parquet in the shared
    folder and is read back as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
