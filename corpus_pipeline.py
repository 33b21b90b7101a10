"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage works on all rows that the one before kept and returns the columns of ``documents``
unchanged, with further ones if there are any; the last returns packed pieces. Defined results:

* quality: rows that the classifier rejects go, by their text alone, with or without a doc_id;
* lines: lines that an earlier line nearly repeats go, and documents that had words and have none
  left; ``n_chars`` is that of the remaining text;
* near duplicates: of each group the document with the smallest doc_id stays, once; documents
  without words or without a doc_id stay; unlike texts of one doc_id are different documents, and
  texts with equal shingle sets under it are one;
* decontamination: documents with a benchmark passage go, each text of a doc_id by itself;
* packing: every remaining document, the empty ones too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from trackmill.llm import decontaminate, line_dedup, ngram_join, packing, quality
from trackmill.llm.common import slices, stored, table, utf8
from trackmill.llm.shingles import ShingleSets

NO_WORD = r"^[ \t-\r]*$"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_accepted(docs, forest)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_lines(docs)
    # the join keeps every row, so what lost all its words is told from what had none
    had = docs.filter(F.col("text").isNull() | F.col("text").rlike(NO_WORD))
    rest = kept.filter(F.col("text").isNotNull() & ~F.col("text").rlike(NO_WORD))
    rows = rest.unionByName(had)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def _named_by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        sets = ShingleSets(list(utf8(rows["text"]))).sums(3).view(np.int64)
        yield rows.append_column("_set", pa.array(sets))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # texts of one doc_id are documents of their own unless their shingle sets are equal
    schema = T.StructType([*docs.schema.fields, T.StructField("_set", T.LongType())])
    named = docs.filter("doc_id is not null").mapInArrow(_named_by_set, schema)
    named = stored(named.withColumn("_node", F.xxhash64("doc_id", "_set")).drop("_set"))
    groups = ngram_join.join_similar(named.select(F.col("_node").alias("doc_id"), "text")).distinct()
    groups = groups.select(F.col("doc_id").alias("_node"), F.col("component_id").alias("_group"))
    first = named.select("_node", "doc_id").distinct().join(groups, "_node").groupBy("_group")
    stays = first.agg(F.min(F.struct("doc_id", "_node")).alias("_first")).select(F.col("_first._node").alias("_node"))
    own = Window.partitionBy("_node").orderBy(F.xxhash64("text"), "text")
    rows = named.join(stays, "_node", "left_semi").withColumn("_nth", F.row_number().over(own)).filter("_nth = 1")
    return rows.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # texts of one doc_id are documents of their own, so a text is known by both
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.matches(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("_found_key")).distinct()
    return docs.join(found, key == found["_found_key"], "left_anti")


def pack_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(stored(packing.token_pieces(docs, file, joined=False)))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_group),
    ("decontaminate", drop_contaminated),
    ("packing", pack_pieces),
]

#: Learned scores, near duplicates, token ids and the search for fillings are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
