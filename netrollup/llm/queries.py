"""The registered queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

from functools import reduce

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.llm import (
    embedding_dedup,
    language,
    lexical_search,
    line_dedup,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    rules,
    token_counts,
    whitening,
)
from netrollup.llm import license as notices
from netrollup.llm.common import staged, table
from netrollup.llm.oracle import ORACLE as ORACLE

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2"
POLICY = "v2"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [(kind, F.col("base")[kind]) for kind in pii.KINDS]
    removed = F.filter("terms", lambda m: m["remove"])
    general = F.filter("terms", lambda m: ~m["remove"])
    return pii.find(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"),
        *[F.size(spans).cast("long").alias(f"n_{kind}") for kind, spans in base],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list([*base, ("generalised", general), ("removed", removed)]).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the declared language is ``lang``, and ``source`` stands for the host."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(
        docs, language.train(docs), declared=F.col("lang"), host=F.col("source")
    ).select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.lang").alias("declared"),
             "text_lang", "lang", F.round("confidence", 4).alias("confidence"), "grams", "kept")


def op2_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages: language of the markup, address suffix and host, with the documents' model."""
    pages = table(spark, sf_dir, "pages")
    host, suffix = language.host_of(F.col("url"))
    return language.identify(
        pages, language.train(table(spark, sf_dir, "documents")),
        text=language.visible_text(F.col("html")), declared=language.declared_of(F.col("html")),
        host=host, suffix=suffix,
    ).select(F.col("doc.page_id").alias("page_id"), "text_lang", "lang",
             F.round("confidence", 4).alias("confidence"), "grams", "kept")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BPE, ranks=RANKS)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = rules.fails("base")
    return rules.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~rules.fails(POLICY)).alias("kept"), "failed")


def op5_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each version of the policy keeps, from one stored ledger."""
    stored = staged(rules.ledger(table(spark, sf_dir, "documents")), "ledger")
    return stored.select("doc_id", "failed", *[
        (~rules.fails(p)).alias(f"kept_{p}") for p in rules.POLICIES])


def op5_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per policy and rule: the documents that fail it, and those that it alone turns away."""
    stored = staged(rules.ledger(table(spark, sf_dir, "documents")), "ledger")
    found = [rules.ablations(stored, p).select(F.lit(p).alias("policy"), "*")
             for p in rules.POLICIES]
    return reduce(DataFrame.unionByName, found)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Shingles of four words are this query's contract; the operator's own default is five.
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = "concat_ws(':', s.label, s.start, s.end, s.edits)"
    return notices.scan_notices(table(spark, sf_dir, "documents")).withColumn(
        "spans", F.expr(f"array_join(transform(spans, s -> {span}), ',')"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = table(spark, sf_dir, "labels").where(f"NOT ({HELD_OUT})")
    model = quality.train(quality.training_rows(docs, learned))
    return quality.score_documents(docs, model).select(
        "doc_id", F.expr(f"coalesce({HELD_OUT}, false)").alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("times") * F.col("size") + F.col("part")).alias("taken"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).select(
        F.col("doc.vec_id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained",
        "identity_error")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2("kept", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "benchmark"),
                                 table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language_id": op2_language_id,
    "op2_language_id_pages": op2_language_id_pages,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_mixing": op10_mixing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_search": op13_lexical_search,
    "op5_policies": op5_policies,
    "op5_ablations": op5_ablations,
    "pipeline": corpus_pipeline.run,
}
