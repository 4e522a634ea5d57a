"""The registered queries of the training-data operators: each derives its columns from one operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    bpe, decontaminate, exact_dedup, jaccard, lexical_search, merkle, quality, quality_rules, secret_scan, surrogates,
    token_files, toxicity, warc,
)
from .texts import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(spark: SparkSession) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)


@query
def op1_exact_dedup(spark, folder):
    found = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op2_benchmark_decontamination(spark, folder):
    hits = decontaminate.benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op3_warc(spark, folder):
    return warc.archived(table(spark, folder, "pages"))


@query
def op4_byte_bpe(spark, folder):
    return bpe.token_digests(bpe.encode(table(spark, folder, "documents"), vocabulary(spark), decoded=True))


@query
def op5_secret_scan(spark, folder):
    found = secret_scan.secret_spans(table(spark, folder, "documents"))

    def joined(kinds: Column) -> Column:
        return F.concat_ws(",", F.transform(kinds, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", *(count(k) for k in secret_scan.KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@query
def op6_pii_surrogates(spark, folder):
    """The key is part of this query so that its result can be told; use a secret one."""
    found = surrogates.pseudonymised(table(spark, folder, "documents"), b"a key for tests only")
    spans = F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"], e["new_start"], e["new_end"]))
    return found.select("doc_id", F.size("entities").cast("bigint").alias("n_entities"), F.concat_ws(",", spans).alias("spans"), "text")


@query
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.with_fold(toxicity.scores(docs, model)).select("doc_id", "held_out", "score", "predicted")


@query
def op8_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels, toxic=toxicity.fit(docs, labels))
    return quality.with_fold(quality.graded(docs, model)).select("doc_id", "held_out", "expected_grade", "tail", "selected")


@query
def op9_token_files(spark, folder):
    return token_files.id_checksums(table(spark, folder, "documents"), TOKENIZER)


@query
def op10_ngram_jaccard(spark, folder):
    return jaccard.similar_documents(table(spark, folder, "documents"))


@query
def op11_lexical_search(spark, folder):
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_quality_rules(spark, folder):
    return quality_rules.ruled(table(spark, folder, "documents"))


@query
def op13_merkle_manifest(spark, folder):
    """The manifest, and a check of it against rows of which some were tampered with."""
    leaf = ("doc_id", "source", "lang", "n_chars", "text")
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    values = [F.col(c) if c != "n_chars" else F.col(c) + 1 for c in leaf]
    found = merkle.manifest(
        table(spark, folder, "documents"), leaf, "lang", tampered=F.when(touched, merkle.leaf(*values)))
    checked = merkle.verified(found.withColumn("candidate", F.coalesce("tampered", "leaf")), "candidate")
    return checked.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
