"""Token counts that follow edits without encoding a document again.

A document keeps a segment tree. Its leaves are pieces of about ``LEAF_CHARS``
characters, cut only where a single space stands between two characters that
are not white space: no pre-token of the byte-pair tokenizers runs over such a
place, whatever lies around it, so a text's tokens are the sum of its leaves'
tokens. Inner nodes hold the sums of characters and tokens.

An edit re-encodes the leaves that it touches, and the neighbour if it comes
within a character of a cut (the boundary context that decides whether the cut
still holds), then updates the sums up to the root. The tree's shape stays:
the first leaf touched takes the new text, the others become empty. When a
leaf has grown past ``SPLIT`` leaves' size it is cut anew and the tree is
built again from the leaves' counts, which encodes nothing.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.staging import small_batches, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS, SPLIT = 256, 4
_CUT = re.compile(r"(?<=\S) (?=\S)")


class TokenCounter:
    """Counts of a byte-pair vocabulary given as the bytes of its file."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        self.encoded = 0

    def count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.encoding.encode_ordinary(text))


def cut_leaves(text: str) -> list[str]:
    """The text in pieces that start at safe cuts; an empty text has one."""
    out, at = [], 0
    while (m := _CUT.search(text, at + LEAF_CHARS)) is not None:
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


class SegmentTree:
    """Sums of characters and tokens over a document's leaves."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.leaves = len(chars)
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size:self.size + len(chars)] = np.column_stack([chars, tokens])
        for level in range(self.size.bit_length() - 2, -1, -1):
            lo, hi = 1 << level, 2 << level
            self.sums[lo:hi] = self.sums[2 * lo:2 * hi:2] + self.sums[2 * lo + 1:2 * hi:2]

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """``(leaf, its first character)`` of the leaf holding character ``at``
        (the last one that isn't empty for the text's end)."""
        node, start = 1, 0
        at = min(at, max(0, int(self.sums[1, 0]) - 1))
        while node < self.size:
            node *= 2
            if at - start >= self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return min(node - self.size, self.leaves - 1), start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.size + leaf
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def columns(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves that hold text."""
        own = self.sums[self.size:self.size + self.leaves]
        own = own[own[:, 0] > 0] if own[:, 0].any() else own[:1]
        return own[:, 0].tolist(), own[:, 1].tolist()


class CountedText:
    """A text with its tree."""

    def __init__(self, text: str, counter: TokenCounter, leaves: tuple[list[int], list[int]] | None = None):
        self.text, self.counter = text, counter
        if leaves is None:
            parts = cut_leaves(text)
            leaves = [len(p) for p in parts], [counter.count(p) for p in parts]
        self.tree = SegmentTree(*leaves)

    def edit(self, at: int, n_delete: int, inserted: str) -> None:
        """Replaces ``n_delete`` characters at ``at``; places past the end mean
        the end."""
        at = min(max(0, at), len(self.text))
        end = min(len(self.text), at + max(0, n_delete))
        # a cut depends on the characters on both its sides
        first, lo = self.tree.find(max(0, at - 2))
        last, hi = self.tree.find(min(len(self.text), end + 2))
        hi += int(self.tree.sums[self.tree.size + last, 0])
        new = self.text[lo:at] + inserted + self.text[end:hi]
        self.text = self.text[:lo] + new + self.text[hi:]
        self.tree.set(first, len(new), self.counter.count(new))
        for leaf in range(first + 1, last + 1):
            if self.tree.sums[self.tree.size + leaf, 0]:
                self.tree.set(leaf, 0, 0)
        if len(new) > SPLIT * LEAF_CHARS:
            parts = cut_leaves(new)
            if len(parts) > 1:
                chars, tokens = (self.tree.sums[self.tree.size:self.tree.size + self.tree.leaves, k].tolist() for k in (0, 1))
                chars[first:last + 1] = [len(p) for p in parts]
                tokens[first:last + 1] = [self.counter.count(p) for p in parts]
                self.tree = SegmentTree(chars, tokens)


# ---- Spark jobs

def _ranks(docs: DataFrame, vocabulary: str):
    """The vocabulary's file as a broadcast value (a few MB, fixed)."""
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


_TREE = "doc_id long, text_hash long, n_tokens long, leaf_chars array<int>, leaf_tokens array<int>"


def _build_udf(ranks, pattern: str):
    def run(batches):
        counter = TokenCounter(ranks.value, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                trees = [CountedText(t or "", counter).tree for t in part.column(2).to_pylist()]
                leaves = [t.columns() for t in trees]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([t.n_tokens for t in trees], pa.int64()),
                     pa.array([x for x, _ in leaves], pa.list_(pa.int32())),
                     pa.array([x for _, x in leaves], pa.list_(pa.int32()))],
                    names=["doc_id", "text_hash", "n_tokens", "leaf_chars", "leaf_tokens"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                                      text.alias("text"))


def build_trees(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The tree of each text of ``docs`` (``doc_id``, ``text``), one for equal
    rows: ``doc_id``, ``text_hash``, ``n_tokens`` and the leaves' characters
    and tokens. A null text is empty and has no tokens."""
    rows = _keyed(docs).mapInArrow(_build_udf(_ranks(docs, vocabulary), pattern), _TREE)
    return rows.dropDuplicates(["doc_id", "text_hash"])


_EDITED = ("doc_id long, text string, n_chars long, n_tokens_before long, n_edits long, n_tokens long, n_encoded long, "
           "leaf_chars array<int>, leaf_tokens array<int>")


def _pack_udf(batches):
    """Texts compressed one by one."""
    z = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in batches:
        packed = pa.array([z.compress(t.encode()) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["doc_id", "text_hash", "text"])


def _edit_udf(ranks, pattern: str, with_text: bool):
    def run(batches):
        counter, unpack = TokenCounter(ranks.value, pattern), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                out = []
                for r in batch.slice(lo, 200).to_pylist():
                    before = counter.encoded
                    doc = CountedText(unpack(r["text"]).decode(), counter, (r["leaf_chars"], r["leaf_tokens"]))
                    edits = r["edits"] or []
                    for e in edits:
                        doc.edit(e["at"], e["n_delete"], e["inserted"])
                    chars, tokens = doc.tree.columns()
                    out.append({"doc_id": r["doc_id"], "text": doc.text if with_text else None, "n_chars": len(doc.text),
                                "n_tokens_before": r["n_tokens"], "n_edits": len(edits), "n_tokens": doc.tree.n_tokens,
                                "n_encoded": counter.encoded - before, "leaf_chars": chars, "leaf_tokens": tokens})
                kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [(n, kinds[k]) for n, k in (x.split() for x in _EDITED.split(", "))]))
    return run


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY,
                pattern: str = PATTERN, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``, with its tree from :func:`build_trees`: ``doc_id``,
    ``text`` (if asked), ``n_chars``, ``n_tokens_before``, ``n_edits``,
    ``n_tokens`` after the edits, ``n_encoded`` (characters encoded for them)
    and the new leaves.

    ``edits`` holds ``doc_id``, ``seq``, ``at``, ``n_delete``, ``inserted``;
    those of a document apply one after another by ``seq`` (then by place),
    each to the text left by the one before, in code points. Nulls mean 0 and
    the empty text. Edits of documents that aren't there are ignored, and
    documents without edits keep their counts. Repeated rows of ``docs`` are
    edited each. A null ``doc_id`` matches edits with a null ``doc_id``."""
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    lists = (edits.select(F.col("doc_id").cast("long").alias("e_id"), F.struct(
        zero("seq"), zero("at"), zero("n_delete"),
        F.coalesce(F.col("inserted").cast("string"), F.lit("")).alias("inserted")).alias("e"))
        .groupBy("e_id").agg(F.sort_array(F.collect_list("e")).alias("edits")))
    # trees and edits meet first: the texts cross one shuffle, compressed
    t = (trees.withColumnsRenamed({"doc_id": "t_id", "text_hash": "t_hash"})
         .join(lists, F.col("t_id").eqNullSafe(F.col("e_id")), "left").drop("e_id"))
    packed = _keyed(docs).mapInArrow(_pack_udf, "doc_id long, text_hash long, text binary")
    rows = (packed.join(t, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_hash") == F.col("t_hash")))
            .select("doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", "edits"))
    return rows.mapInArrow(_edit_udf(_ranks(docs, vocabulary), pattern, with_text), _EDITED)


def revision_edits(docs: DataFrame, every: int = 2_000) -> DataFrame:
    """A revision of each document, derived from the table: one edit for every
    ``every`` characters begun, which replaces up to 30 characters at a hashed
    place by up to 40 characters from another place of the same text."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text <> ''")
    n = F.length("text")
    d = d.select("doc_id", "text", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor(n / every).cast("int"))).alias("seq"))
    h = lambda k: F.pmod(F.xxhash64("doc_id", "seq", F.lit(k)), F.col("n"))
    return d.select("doc_id", "seq", h(1).alias("at"), F.pmod(F.xxhash64("doc_id", "seq", F.lit(2)), F.lit(31)).alias("n_delete"),
                    F.substring(F.col("text"), h(3).cast("int") + 1, F.pmod(F.xxhash64("doc_id", "seq", F.lit(4)), F.lit(41)).cast("int"))
                    .alias("inserted"))


def count_after_edits(docs: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Trees of ``docs``, written to the shared folder, and the counts after
    ``edits``: see :func:`apply_edits`."""
    trees = staged(build_trees(docs, vocabulary, pattern), "token-trees")
    return apply_edits(docs, trees, edits, vocabulary, pattern).drop("text", "leaf_chars", "leaf_tokens")
