"""A corpus pipeline over the operators of ``kerbside.llm``: what is left of ``documents``, clean and encoded.

Every stage works on all that the stage before kept; a stage that filters keeps whatever it has nothing against.
"""

from kerbside.llm import bpe, decontaminate, jaccard_join, langid, pii
from kerbside.session import write_stage


def language(spark, docs, sf_dir):
    """Documents whose language is identified; models learn from the languages given in ``docs``."""
    return langid.keep_identified(docs, langid.train(docs))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of a shingle similarity of 0.75 or more."""
    return jaccard_join.keep_one(docs, percent=75)


def benchmark_leaks(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind and ``n_chars`` brought up to date."""
    return pii.redact(docs, pii.train(docs), chars_col="n_chars")


def encode(spark, docs, sf_dir):
    """Token ids of every document as digests, with the decoded text."""
    return bpe.round_trip(docs)


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("decontamination", benchmark_leaks),
          ("pii", personal_data), ("bpe_encoding", encode)]

#: Models and tokenizers are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spark.read.parquet(write_stage(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
