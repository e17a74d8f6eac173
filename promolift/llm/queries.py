"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import binary, extraction, language_model, licenses, mixing, neardup, neighbours, pieces, quality, resampling, secrets, sql, toxicity, trie
from .common import crc_mod, read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), passed=("doc_id",))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP3_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select(*OP3_COLUMNS)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(read(spark, sf_dir, "documents"), width=3, percent=85)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 5) == 1
    found = language_model.scores(read(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = extraction.main_text(pages, extraction.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = read(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 0
    net = toxicity.fit(documents.where(~held_out), read(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(documents, net).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.own_turns(read(spark, sf_dir, "conversations"))
    rows, convs = trie.branched(turns, base=lambda c: c - c % 5, length=lambda c: F.crc32(c.cast("string").cast("binary")) % 9, most=8)
    return trie.nodes(rows, convs)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = binary.write(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)
    return binary.checksums(spark, folder)


def queries() -> dict:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_mix_sources": op2_mix_sources,
        "op3_quality_rules": op3_quality_rules,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_language_model": op5_language_model,
        "op6_secret_scan": op6_secret_scan,
        "op7_html_text": op7_html_text,
        "op8_license_scan": op8_license_scan,
        "op9_toxicity": op9_toxicity,
        "op10_nearest_vectors": op10_nearest_vectors,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
