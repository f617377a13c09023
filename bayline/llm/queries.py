"""Registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from bayline.llm.bpe_stream import encode_and_decode
from bayline.llm.collocations import collocations, collocations_sql
from bayline.llm.decontaminate import find_leaks
from bayline.llm.embedding_dedup import near_duplicate_vectors
from bayline.llm.fill_in_middle import fill_in_middle_digests, fill_in_middle_sql
from bayline.llm.minhash_dedup import near_duplicates
from bayline.llm.mixing import mix
from bayline.llm.pii import find_pii, fit_pii
from bayline.llm.secret_scan import scan_secrets, scan_sql
from bayline.llm.substring_dedup import remove_repeated_passages
from bayline.llm.token_counts import count_after_edits, revision_edits
from bayline.llm.toxicity import toxicity
from bayline.llm.warc import ROUND_TRIP_SQL, archive_round_trip
from bayline.sources.tables import read_table


def op1_embedding_dedup(spark, sf_dir):
    """Near-duplicate vectors of cosine 0.9 or more, all rows of ``embeddings``."""
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark, sf_dir):
    """Words left after removing every repeated 35-word passage."""
    return remove_repeated_passages(read_table(spark, sf_dir, "documents"), k=35)


def op3_decontamination(spark, sf_dir):
    """Benchmark items found in all documents."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_pii(spark, sf_dir):
    """Personal data in all documents; the random field is trained on a small
    table of labelled sequences, made by rule and from them."""
    docs = read_table(spark, sf_dir, "documents")
    return find_pii(docs, fit_pii(docs))


def op5_secret_scan(spark, sf_dir):
    """Secrets in all documents, found through a trigram index."""
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op6_minhash_dedup(spark, sf_dir):
    """Near-duplicate components over 2-word shingles, Jaccard 0.8 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=2)


def op7_warc(spark, sf_dir):
    """All pages written to compressed WARC archives and read back."""
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def op8_token_counts(spark, sf_dir):
    """Token counts of all documents before and after a derived revision."""
    docs = read_table(spark, sf_dir, "documents")
    return count_after_edits(docs, revision_edits(docs))


def op9_mixing(spark, sf_dir):
    """All documents mixed to weights 1, 2, 3 by source, three passes at most."""
    return mix(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    """Scores of all documents, learnt from the training share of ``labels``."""
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_bpe_stream(spark, sf_dir):
    """All documents encoded by the byte-level vocabulary and decoded again."""
    return encode_and_decode(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    """Fill-in-middle samples of all documents, and the texts rebuilt from them."""
    return fill_in_middle_digests(read_table(spark, sf_dir, "documents"), seed=42)


def op13_collocations(spark, sf_dir):
    """The 2000 best phrases of two or three words in each language."""
    return collocations(read_table(spark, sf_dir, "documents"), top=2000)


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_secret_scan": op5_secret_scan,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_warc": op7_warc,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_bpe_stream": op11_bpe_stream,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {
    "op5_secret_scan": scan_sql(),
    "op7_warc": ROUND_TRIP_SQL,
    "op12_fill_in_middle": fill_in_middle_sql(),
    "op13_collocations": collocations_sql(),
}
