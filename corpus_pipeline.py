"""Cleaning a document corpus for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, as
they are to be used; its output is written as Parquet and reread as the next
stage's input. The last stage returns the packed sequences.

1. quality: documents that the adaptive rules reject go.
2. ngram_join: one document of each group of near copies stays (five-word
   shingles, similarity 0.8 or more).
3. suffix_array: bytes of strings of `REPEAT_BYTES` bytes that occur elsewhere
   go. Fifty-one words have some 315 bytes, so the 400 bytes of the query of
   that operator would leave passages of over 50 words.
4. decontamination: documents that hold benchmark passages go.
5. packing: sequences of at most 4096 words, batches by length bucket.

Edge cases: a null, empty or very short text goes in the first stage, as the base
rule rejects it; of repeated rows one stays, as of near copies; documents without
an id are judged as others, and the smallest id of a group stays before them; a
document that is cut stays, also when nothing of it is left; an empty table gives
an empty result in every stage; other columns, whatever their names, stay as they are
until the last stage. The longest text is bounded by a worker's memory (some 25 bytes
for each of its own).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import common
from marketlens.llm.decontamination import keep_clean
from marketlens.llm.ngram_join import one_of_each
from marketlens.llm.packing import pack, word_counts
from marketlens.llm.quality_rules import keep_good
from marketlens.llm.suffix_array_dedup import without_repeats

#: Bytes of a repeated string in the stage suffix_array.
REPEAT_BYTES = 250

_made: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """Before a stage, drop the scratch tables of the one before: its output is written."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, _made)
        _made.clear()
        before = len(common.written)
        out = work(spark, docs, sf_dir)
        _made.extend(common.written[before:])
        return out
    return run


STAGES = [
    ("quality", _stage(lambda spark, docs, sf_dir: keep_good(docs))),
    ("ngram_join", _stage(lambda spark, docs, sf_dir: one_of_each(docs, n=5, num=4, den=5))),
    ("suffix_array", _stage(lambda spark, docs, sf_dir: without_repeats(docs, window=REPEAT_BYTES))),
    ("decontamination", _stage(lambda spark, docs, sf_dir: keep_clean(
        docs, common.table(spark, sf_dir, "benchmark")))),
    ("packing", _stage(lambda spark, docs, sf_dir: pack(common.materialize(
        word_counts(docs, ("doc_id",)), "lengths")))),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{common.scratch_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Signature trees, dynamic programming and suffix sorting are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL = None
