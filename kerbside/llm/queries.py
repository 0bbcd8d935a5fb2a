"""The registered queries of this subpackage: each applies one operator to its whole table."""

from pyspark.sql import functions as F

from kerbside.llm import (
    bpe, cotraining, cover_tree, curriculum, decontaminate, filter_audit, jaccard_join, langid, pii, secret_scan, sharding, token_counts,
    vector_codes)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_pii_crf(spark, folder):
    """Personal data in every document: base spans, and what the trained field adds."""
    documents = table(spark, folder, "documents")
    return pii.scan(documents, pii.train(documents))


def op2_bpe_encoding(spark, folder):
    """Ids and decoded text of every document, as digests."""
    return bpe.round_trip(table(spark, folder, "documents"))


def op3_quality_cotraining(spark, folder):
    """The quality of every document; labels of the third that is held out are not learned from."""
    documents = table(spark, folder, "documents")
    model = cotraining.train(documents, langid.learning_rows(table(spark, folder, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return cotraining.score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "keep")


def op4_token_counts(spark, folder):
    """Bytes and tokens of every document, and where it must be cut to hold at most 4096 tokens."""
    counts = token_counts.count(table(spark, folder, "documents"), limits=(4096,))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"),
                         F.col("cuts")[0].alias("chars_within_limit"))


def op5_ngram_jaccard(spark, folder):
    """Components of documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.similar_components(table(spark, folder, "documents"), percent=75)


def op6_language_id(spark, folder):
    """The language of every document, learned from two thirds of them."""
    documents = table(spark, folder, "documents")
    found = langid.identify(documents, langid.train(langid.learning_rows(documents)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_hilbert_shards(spark, folder):
    """Eight shards of all documents along a Hilbert curve over language, source and size, equal in rows."""
    documents = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    narrow = documents.select("doc_id", "lang", "source", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"))
    placed = sharding.place(narrow, 8, ["lang", "source", "size"], keep=["text_crc32", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_benchmark_leaks(spark, folder):
    """The benchmark items in every document."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_secret_ownership(spark, folder):
    """Secrets in every document, with verdicts from how many owners hold them."""
    return secret_scan.scan(table(spark, folder, "documents"))


def op10_embedding_neighbours(spark, folder):
    """Links, component and survivor of every embedding at cosine 0.93 within its label."""
    return cover_tree.near_duplicates(table(spark, folder, "embeddings"))


def op11_vector_codes(spark, folder):
    """A code of four bytes for every embedding, and what it loses."""
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op12_source_mix(spark, folder):
    """All documents in the order of training, with the words that the mix takes of each."""
    mixed = curriculum.mix(table(spark, folder, "documents"))
    return curriculum.ordered_by_due(mixed).select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op13_filter_audit(spark, folder):
    """What five text filters remove of each source, in every order."""
    return filter_audit.audit_texts(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_pii_crf, op2_bpe_encoding, op3_quality_cotraining, op4_token_counts, op5_ngram_jaccard, op6_language_id, op7_hilbert_shards,
    op8_benchmark_leaks, op9_secret_ownership, op10_embedding_neighbours, op11_vector_codes, op12_source_mix, op13_filter_audit)}
