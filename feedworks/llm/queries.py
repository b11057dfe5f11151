"""The operators as registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm import exact, fingerprints, language, mixing, neardup, packing, periods, pii, secrets, sharding, simhash, spelling, toxicity
from feedworks.llm.rows import text_of


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces in their sequences, the ids of each as a checksum."""
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(workspace.materialise(pieces, "pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(_read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _span_digest(spans, kinds: tuple[str, ...]):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans, *kinds: int):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(_read(spark, sf_dir, "documents"))
    counts = [F.size(_of_kind("spans", i)).cast("long").alias(f"n_{secrets.KINDS[i]}") for i in range(3)]
    return found.select("doc_id", *counts, F.sha2(_span_digest(_of_kind("spans", 0, 1, 2), secrets.KINDS), 256).alias("base_sha256"),
                        _span_digest(F.col("spans"), secrets.KINDS).alias("spans"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.page_languages(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(_read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place_documents(_read(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_read(spark, sf_dir, "documents"))
    kinds = (*pii.KINDS, *(f"near_{kind}" for kind in pii.KINDS))
    counts = [F.size(_of_kind("spans", i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(_span_digest(_of_kind("spans", 0, 1, 2, 3), kinds), 256).alias("base_sha256"),
                        _span_digest(F.col("spans"), kinds).alias("spans"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = periods.periodic_runs(docs, periods.with_repeats(text_of(docs), docs["doc_id"]), "doc_id")
    # Of equal shares the first in order stays, which begins first.
    most = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda run: F.concat(F.concat_ws(
        ",", *[run[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"most.{c}") for c in ("start", "length", "period")],
        F.floor(1000 * F.col("most.length") / F.col("most.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.similar_documents(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_window_packing, op3_exact_dedup, op4_secret_scan,
    op5_near_duplicates, op6_page_language, op7_toxicity, op8_fingerprints,
    op9_sharding, op10_personal_data, op11_periodic_runs,
    op12_simhash_near_duplicates, op13_spelling_variants)}
