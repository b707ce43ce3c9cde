"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, fingerprints, html_text, language_id, lexical_search, license_scan, mixing, near_duplicates, pii, token_alignment, token_counts, topk,
)
from .common import read_table
from .oracles import ORACLES


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn_weights(pages))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    read = chat.read_packs(chat.format_conversations(rows))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, "spans")
    base = [k.name for k in pii.KINDS if k.base]
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.array_join(F.transform(of_base, as_text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", as_text), ",").alias("spans"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), size=3, num=90, den=100)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out(docs)).select("text", "lang"))
    rows = docs.select("doc_id", "text", language_id.held_out(docs).alias("held_out"))
    return language_id.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.neighbours(read_table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = token_alignment.align_documents(read_table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_html_text": op2_html_text,
        "op3_token_counts": op3_token_counts,
        "op4_topk": op4_topk,
        "op5_chat_format": op5_chat_format,
        "op6_pii": op6_pii,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_license_scan": op8_license_scan,
        "op9_language_id": op9_language_id,
        "op10_mixing": op10_mixing,
        "op11_lexical_search": op11_lexical_search,
        "op12_fingerprints": op12_fingerprints,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
