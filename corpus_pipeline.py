"""A training corpus in five stages, each on all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of
``docs``.

1. toxicity: documents scored at or above the threshold go.
2. exact_dedup: of equal texts one row stays.
3. near_dedup: of each component of near duplicates one row stays.
4. mixing: a document comes once, repeated, or not at all, as often as the mix takes
   it (words taken over its size, rounded half up).
5. packing: pieces of token ids in sequences, ids as a checksum.

Defined results: see the operators. Other columns of ``docs`` go along unchanged up
to the last stage; an empty table yields empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm import exact, mixing, neardup, toxicity
from feedworks.llm.queries import packed_pieces
from feedworks.llm.rows import ROW, broadcast_if_small, text_of, with_documents


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(model.score(text_of(docs)) < toxicity.THRESHOLD)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``dropped``. Where those are few, the texts don't move."""
    rows = workspace.materialise(dropped.select(*ROW), "dropped")
    return with_documents(docs, broadcast_if_small(rows), "left_anti")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, exact.exact_groups(docs).filter("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, neardup.near_duplicates(docs).filter("not stays"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = workspace.materialise(
        mixing.mix(docs).filter("size > 0").select(*ROW, times.alias("__times")).filter("__times > 0"), "taken")
    whole = with_documents(docs, broadcast_if_small(taken))
    return whole.withColumn("__times", F.explode(F.sequence(F.lit(1), "__times"))).drop("__times")


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES = [("toxicity", toxic_documents), ("exact_dedup", exact_duplicates), ("near_dedup", near_duplicates),
          ("mixing", source_mix), ("packing", packed_windows)]

#: A trained model and a tokenizer are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
