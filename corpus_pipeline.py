"""A corpus pipeline over ``documents``: five stages, each a training-data operator at work on what is left.

1. ``language_id``: documents without a language (no text, or no letter in it) go.
2. ``ngram_join``: of each group of near-duplicates the document with the smallest id stays (nulls last; among equal
   ids, the least digest of the text).  Rows have numbers of their own here, so null and repeated ids lose nothing.
3. ``suffix_dedup``: strings of 50 bytes that also start in a document with a smaller id are cut out, in whole
   characters; documents of which nothing is left go.
4. ``mixing``: the sources are mixed to their target weights; a document appears once for each pass of the mix that
   takes words of it, with the words taken.
5. ``sentencepiece``: the texts are encoded; the digests of ids and decoded texts are the result.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written and read again for the next, so when
a stage begins, the helper tables of the stage before it, on the same folder, have done their work and are dropped.
Helper tables of anything else in the session are left alone.  ``run`` drops the table of a stage once the next one
is written; the last one's is dropped when the session ends, as the result reads it.

Defined results: documents without text go in stage 1, so blank ones do not reach the others; null and repeated ids,
repeated rows, ties and very long texts are as the operators define them, and lose nothing; an empty table gives no
rows; documents can have further columns of any name, which stages 1 to 4 keep.
"""

from __future__ import annotations

import contextlib
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.llm.common import Tables, free_name, materialize, numbered, owned, read, text_bytes
from placewright.llm.language_id import learn, predict
from placewright.llm.mixing import mixed_documents
from placewright.llm.ngram_join import jaccard_components
from placewright.llm.piece_codec import piece_digests
from placewright.llm.suffix_dedup import without_repeats

#: Rows of an Arrow batch while stages run: they share the workers' memory.  Set only where the session has the default.
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
_DEFAULT = "10000"
_helpers: dict[tuple[str, int], list[Tables]] = {}


def _stage(number: int):
    """Helper tables that a stage writes are its own; those of the stage before it on this folder go."""

    def wrap(f):
        @functools.wraps(f)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for tables in _helpers.pop((sf_dir, number - 1), []):
                tables.drop(spark)
            if spark.conf.get(BATCH[0], _DEFAULT) == _DEFAULT:
                spark.conf.set(*BATCH)
            with owned() as tables:
                _helpers.setdefault((sf_dir, number), []).append(tables)
                return f(spark, docs, sf_dir)

        return run_stage

    return wrap


@_stage(1)
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = free_name("lang_pred", docs.columns), free_name("score", docs.columns)
    return predict(docs, learn(docs), docs.columns, names=names).filter(F.col(names[0]) != "und").drop(*names)


@_stage(2)
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = free_name("row", docs.columns)
    rows = numbered(docs, "rows", row)
    # what is first must not depend on the numbers: id, text, then the other columns
    order = rows.select(F.col(row).alias("row"), F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(text_bytes(), 256), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.col(row).alias("row")).alias("order"))
    parts = jaccard_components(rows, id_col=row).select(F.col("doc_id").alias("row"), "component_id")
    first = parts.join(order, "row").groupBy("component_id").agg(F.min("order").alias("order")).select(F.col("order.row").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage(3)
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


@_stage(4)
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


@_stage(5)
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(docs)


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("suffix_dedup", suffix_dedup), ("mixing", mixing), ("sentencepiece", sentencepiece)]

#: Language ID, the permutations of the mix and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    before, had = None, spark.conf.get(BATCH[0], _DEFAULT)
    try:
        for k, (name, stage) in enumerate(STAGES[:-1]):
            # the last table written has to outlive this call, so it is the session's
            with owned() if k + 2 < len(STAGES) else contextlib.nullcontext() as tables:
                docs = materialize(stage(spark, docs, sf_dir), name)
            if before:
                before.drop(spark)
            before = tables
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        spark.conf.set(BATCH[0], had)
