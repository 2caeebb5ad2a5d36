"""The registered queries of the operators, one for each; they read the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (
    decontamination,
    fingerprints,
    hard_negatives,
    jaccard,
    language_model,
    merkle,
    mixing,
    owners,
    passages,
    quality,
    sharding,
    suffixes,
    toxicity,
)
from riskmart.llm.words import crc_of_id, plain


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of each text and of its edited text, their likeness, and how many fingerprints lie near (for ids divisible by 50)."""
    own = fingerprints.with_next(documents(spark, sf_dir), lambda rows: fingerprints.simhash(rows.withColumn("source_text", F.col("text")), {"source_text": "own"}))
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = own.select(
        F.col("next_doc_id").alias("__next"),
        "doc_id",
        size.cast("long").alias("n_chars"),
        "own",
        "next_own",
        F.concat(F.substring(F.col("text"), F.lit(1), size - cut), F.substring(F.col("next_text"), F.lit(1), cut)).alias("edited"),
    ).drop("__next")
    made = fingerprints.simhash(edited.withColumn("edited_sha256", F.sha2("edited", 256)), {"edited": "changed"})
    rows = made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.hexadecimal(F.col("own")).alias("fingerprint"),
        fingerprints.hexadecimal(F.col("changed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        fingerprints.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        F.col("own").alias("__own"),
    )
    prints = fingerprints.simhash(plain(documents(spark, sf_dir), "doc_id", "text"), {"text": "fingerprint"})
    counts = fingerprints.near_counts(prints, F.col("doc_id") % 50 == 0).select(F.col("fingerprint").alias("__own"), "n_within")
    joined = rows.join(counts, "__own", "left")
    return joined.select(*(c for c in rows.columns if c != "__own"), F.when(F.col("doc_id") % 50 == 0, F.col("n_within") - 1).alias("n_near"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of each text by a word-pair model and by word counts; ids with remainder 0 by 10 are not learnt from."""
    return language_model.score(documents(spark, sf_dir), crc_of_id("key") % 10 == 0)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class by near-duplicate passages of 50 words or more, and how much of it they cover."""
    return passages.repeated_passages(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each text; rows whose id has remainder 1 by 3 are held out of training."""
    docs = documents(spark, sf_dir)
    held_out = crc_of_id() % 3 == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    scored = quality.score(docs, quality.learn(docs, labels, "quality"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many bytes of each text are covered by 100 bytes that also start earlier, and a digest of the rest."""
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return suffixes.remove_repeats(documents(spark, sf_dir), keep_text=False).select(*columns)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of 5-word shingles and its component of links of similarity 0.75 or more."""
    return jaccard.link_components(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes from each document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "times")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each text with its offending sentences; rows whose id has remainder 0 by 5 are held out of training."""
    docs = documents(spark, sf_dir)
    held_out = crc_of_id() % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    scored = toxicity.score(docs, toxicity.learn(docs, labels, "toxic"))
    extra = ["n_sentences", "n_offending", "worst_start", "worst_end"]
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *extra)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document among 64, and where it goes with a 65th."""
    rows = documents(spark, sf_dir).select("doc_id")
    placed = sharding.assign_shards(rows, "doc_id", 64)
    grown = sharding.assign_shards(placed, "doc_id", 65, shard="grown_shard", slot="grown_slot")
    return grown.select("doc_id", "slot", "shard", "grown_shard")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place where a document holds a benchmark item within the edit budget."""
    return decontamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of texts equal but for A-Z and a-z that each document is in, and which row of it stays."""
    return owners.owners(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For vectors whose id is divisible by 50: the hardest allowed negatives of each of their positives."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether each document, some without their line ends, still gives its root."""
    docs = documents(spark, sf_dir)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    changed = merkle.leaf_digest(*(tampered if c == "text" else F.col(c) for c in merkle.FIELDS))
    made = merkle.manifest(docs, changed=changed).withColumn("folded_root", merkle.folded(F.col("changed"), F.col("proof")))
    proof = merkle.digest(merkle.proof_text(F.col("proof"))).alias("proof_sha256")
    return made.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_language_model,
        op3_passages,
        op4_quality,
        op5_suffix_dedup,
        op6_jaccard_join,
        op7_mixing,
        op8_toxicity,
        op9_sharding,
        op10_decontamination,
        op11_owners,
        op12_hard_negatives,
        op13_merkle,
    )
}


def oracles() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    from riskmart.llm.oracles import ORACLES

    return dict(ORACLES)
