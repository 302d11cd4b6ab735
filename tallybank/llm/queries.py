"""The registered queries of this subpackage, and the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.llm import (
    op1_token_files,
    op2_quality_model,
    op3_toxicity,
    op4_pieces,
    op5_quality_rules,
    op6_neighbours,
    op7_source_mix,
    op8_passages,
    op9_language,
    op10_ngram_join,
    op11_packing,
    op12_repair,
    op13_manifest,
    folds,
)
from tallybank.llm.stored import remove, short_batches, stored
from tallybank.session import scratch_path

SQL = Path(__file__).parent / "sql"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    manifest = op1_token_files.write_sequences(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    return op1_token_files.read_documents(folder, manifest)


def op3_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = op3_toxicity.train(folds.labelled(docs, labels, "toxic", 5, 0, op3_toxicity.MOST_ROWS))
    return judged(op3_toxicity.score(docs.select("doc_id", "text"), weights), 0.5)


def judged(scores: DataFrame, least: float) -> DataFrame:
    return scores.select(
        "doc_id",
        (folds.fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op5_quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted, _ = stored(op5_quality_rules.count_texts(table(spark, sf_dir, "documents")), "quality-counts")
    columns = ["doc_id", *op5_quality_rules.COUNTS[:5], "base_failed", "kept", "p_good", "votes"]
    return op5_quality_rules.judge(counted).select(*columns)


def op9_language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted, path = stored(op9_language.count_words(docs.filter(folds.fold("doc_id", 4) != 2)), "language-words")
    model = op9_language.learn(counted)
    remove(spark, [path])
    predicted = op9_language.predict(docs, model)
    return predicted.select("doc_id", (folds.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_quality_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors = op2_quality_model.context_vectors(docs)
    known = folds.labelled(docs, labels, "quality", 5, 0, op2_quality_model.MOST_ROWS)
    return judged(op2_quality_model.score(docs, vectors, op2_quality_model.train(known, vectors)), 0.3)


def op7_source_mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op7_source_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_neighbours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return op6_neighbours.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


def op10_ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_ngram_join.join(table(spark, sf_dir, "documents"))


def op4_pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, model = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    ids = F.col("piece_ids")
    return op4_pieces.encode(docs, model, ["doc_id"]).select(
        "doc_id", F.size(ids).cast("long").alias("n_pieces"), F.xxhash64(ids).alias("ids_hash"), "round_trip"
    )


def op8_passages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_passages.passages(table(spark, sf_dir, "documents"))


def op11_packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return op11_packing.pack(op11_packing.pieces(table(spark, sf_dir, "documents"), tokenizer, end_id=2))


def op12_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = op12_repair.repair(op12_repair.damaged(conversations))
    summary, _ = stored(repaired.summary, "conversation-summary")
    repaired.summary = summary
    hashed = repaired.digests().select(F.col("conv_id").alias("hashed"), "sha256")
    left = summary.join(hashed, F.col("conv_id").eqNullSafe(F.col("hashed")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = left.select(F.col("conv_id").alias("found"), *numbers, "audit", "sha256")
    ids = conversations.select("conv_id").distinct()
    empty = {"audit": F.lit(""), "sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", empty["audit"]).alias("audit"),
        F.coalesce("sha256", empty["sha256"]).alias("repaired_sha256"),
    )


def op13_manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    sources, top = op13_manifest.manifest(op13_manifest.leaves(table(spark, sf_dir, "documents"), tampered))
    proofs = op13_manifest.verified(op13_manifest.prove(sources, top))
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files_query,
    "op3_toxicity": op3_toxicity_query,
    "op5_quality_rules": op5_quality_rules_query,
    "op9_language": op9_language_query,
    "op2_quality_model": op2_quality_model_query,
    "op7_source_mix": op7_source_mix_query,
    "op6_neighbours": op6_neighbours_query,
    "op10_ngram_join": op10_ngram_join_query,
    "op4_pieces": op4_pieces_query,
    "op8_passages": op8_passages_query,
    "op11_packing": op11_packing_query,
    "op12_repair": op12_repair_query,
    "op13_manifest": op13_manifest_query,
}


def oracle_sql() -> dict[str, str]:
    return {file.stem: file.read_text() for file in sorted(SQL.glob("*.sql"))}
