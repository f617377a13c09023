"""Corpus pipeline over ``documents``: STAGES in order, each reading what the
one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. Stage by stage:

1. ``toxicity``: documents scored 0.7 or more go; learnt from ``labels``.
2. ``near_dedup``: of each group of near duplicates (five-word shingles,
   Jaccard 0.8 or more) the document with the smallest ``doc_id`` stays.
3. ``decontaminate``: documents that hold an item of ``benchmark`` go.
4. ``pii``: personal data in ``text`` is replaced by its kind in brackets and
   ``n_chars`` counted again; no document goes.
5. ``mix``: ids, sources and languages of all documents left, with the words that the mix takes from each;
   the sources' targets come from the documents left.

A null text is an empty one for every stage and stays null. A null ``doc_id``
is never a near duplicate. Equal rows of one ``doc_id`` are near duplicates of
themselves: one of them stays. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.llm import decontaminate as leaks
from bayline.llm import minhash_dedup, mixing, pii, toxicity
from bayline.llm.staging import staged
from bayline.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.without_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs, pii.fit_pii(docs))
    if "n_chars" in out.columns:
        n = F.length("text").cast(out.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(n, F.col("n_chars")))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, columns=("source", "lang"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("pii", redact_pii),
    ("mix", mix_sources),
]

# a classifier, a random field and a singular value decomposition have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages, each written as Parquet in the shared
    folder and read again; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
