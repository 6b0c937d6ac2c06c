"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import (bisector_clusters, filter_audit, langid, license_index, mixture, ngram_join, packing, pii,
                            pq_dedup, quality_ledger, sentence_spans, url_rules, word_bpe)
from tableflow.llm.common import table

#: The policy that the quality query and the pipeline apply.
POLICY = "full-1"
#: Source weights repeat by the source's place.
WEIGHTS = (1, 2, 3)
#: The packing query's vocabulary file.
TOKENIZER = "byte_bpe_50k.json"
#: The vocabulary file of the encoding query.
WORD_VOCABULARY = "word_bpe_49k.json"
#: Rules of the URL query.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


def weight_by_place(place: int, _name: str | None) -> float:
    return float(WEIGHTS[place % len(WEIGHTS)])


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; a path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of all documents with the verdict of the current policy."""
    ledger = quality_ledger.evaluate_rules(table(spark, sf_dir, "documents"))
    base = quality_ledger.policy_mask(quality_ledger.POLICIES["base-1"])
    mask = quality_ledger.policy_mask(quality_ledger.POLICIES[POLICY])
    out = quality_ledger.apply_policy(ledger, base, "base_passed")
    return quality_ledger.apply_policy(out, mask).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed_bits",
        (~F.col("base_passed")).alias("base_failed"), "kept")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes of every document."""
    return mixture.mix(table(spark, sf_dir, "documents"), weight_by_place).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    out = license_index.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                      F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
                      "base_labels", "labels", "score")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL rules on every page."""
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(tokenizer))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings within a label, at a cosine of 0.98."""
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.fit(docs, ~held_out & F.col("doc_id").isNotNull())
    return langid.predict(docs, model, keep=[held_out.alias("held_out")])


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on 4-word n-grams at a Jaccard similarity of 0.85."""
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), 4, 85).drop("rowkey", "component")


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier one has."""
    return sentence_spans.remove_repeats(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, plain and disguised."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s.getField("disguised"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.getField("kind") == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of every order of five filters over all documents."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 finite components in 40 clusters after five rounds."""
    placed, centroids = bisector_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return bisector_clusters.with_inertia(placed, centroids)


def op13_word_bpe(spark: SparkSession, sf_dir: str, tokenizer: str = WORD_VOCABULARY) -> DataFrame:
    """Digests of the token ids of all documents and of the texts decoded from them."""
    path = tokenizer_path(tokenizer)
    coded = word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_source_mix, op3_license_scan, op4_best_fit_packing, op5_embedding_dedup,
        op6_language_id, op7_url_rules,
        op8_ngram_jaccard, op9_sentence_spans, op10_personal_data, op11_filter_audit, op12_bisector_clusters,
        op13_word_bpe)}
