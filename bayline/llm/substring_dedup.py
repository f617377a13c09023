"""Removal of word passages that occur more than once (count-min prefilter).

A window is ``k`` consecutive words of one text. Every word covered by a
window whose word sequence also starts anywhere else (same text included) is
removed; windows are judged on the input.

1. Every task hashes all windows of its texts and, for each of the sketch's
   ``rows`` hash rows, notes which cells it hit once and which more often. The
   notes leave the task as compressed bit slices and are merged per slice, in
   a stream of sorted rows. The merged sketch overestimates counts, so a cell
   hit at most once proves that its window is unique.
2. Only windows whose every cell was hit more than once are sent on. They are
   counted exactly, by a 96-bit hash of the words, combined before the
   shuffle: a passage shared by a third of all texts is one row per task.
   Counts of 1 are the sketch's mistakes; each belongs to one text.
3. Per text: windows that the sketch calls repeated, less the mistakes, are
   the repeated ones. No repeated window is ever shipped back to its texts.

The sketch has about two cells a window and hash row, up to ``max_bits``
(2**28 cells: 32 MB broadcast for each row). Past that it only filters less:
the exact count in step 2 decides, whatever the sketch lets through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.staging import shuffle_partitions, small_batches
from bayline.llm.words import CHUNK_BYTES, WordHasher, text_buffer, text_chunks

SLICE_BITS = 20
FLUSH_WINDOWS = 1 << 22


def _windows(hasher: WordHasher, data, offsets, k: int):
    """``(row, position, hash 1, hash 2, words per row, word starts and ends)``
    of a chunk's windows."""
    h, rows, starts, ends = hasher.words(data, offsets)
    a, b = hasher.sequences(h, k), hasher.sequences(h, k, second=True)
    inside = np.flatnonzero(rows[:len(a)] == rows[k - 1:]) if len(a) else np.zeros(0, np.int64)
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(n_words)])
    return (rows[inside], inside - first[rows[inside]], a[inside], b[inside], n_words, first,
            starts, ends)


def _cells(a: np.ndarray, b: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each window in one hash row (double hashing)."""
    return ((a + np.uint64(row) * (b | np.uint64(1))) >> np.uint64(64 - bits)).astype(np.uint32)


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cells of one slice as gaps of one byte, 255 meaning "255 and the
    next byte on top": about one byte a cell, less after compression."""
    at = (cells & np.uint32((1 << SLICE_BITS) - 1)).astype(np.int64)
    gaps = np.diff(at, prepend=0)
    end = np.cumsum(gaps // 255 + 1)
    out = np.full(end[-1], 255, np.uint8)
    out[end - 1] = gaps % 255
    return zstandard.compress(out.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    """Bit map of a slice from :func:`_packed`."""
    v = np.frombuffer(zstandard.decompress(data), np.uint8)
    bits = np.zeros(1 << SLICE_BITS, np.uint8)
    bits[np.cumsum(v, dtype=np.int64)[v < 255]] = 1
    return np.packbits(bits)


def _sketch_rows(cells: list[np.ndarray], row: int) -> Iterator[dict]:
    c = np.sort(np.concatenate(cells))
    again = np.zeros(len(c), bool)
    again[1:] = c[1:] == c[:-1]
    for kind, found in ((1, c[~again]), (2, np.unique(c[again]))):
        at = found >> np.uint32(SLICE_BITS)
        slices, begin = np.unique(at, return_index=True)
        for s, part in zip(slices, np.split(found, begin[1:])):
            yield {"row": row, "slice": int(s), "kind": kind, "bits": _packed(part)}


SKETCH_TYPE = "row int, slice int, kind int, bits binary"
_SKETCH_ARROW = pa.schema([("row", pa.int32()), ("slice", pa.int32()), ("kind", pa.int32()),
                           ("bits", pa.binary())])


def _sketch_udf(k: int, rows: int, bits: int):
    def run(batches):
        hasher, kept, n = WordHasher(), [[] for _ in range(rows)], 0

        def flush():
            for r in range(rows):
                out = []
                for x in _sketch_rows(kept[r], r):
                    out.append(x)
                    if len(out) == 64:
                        yield pa.RecordBatch.from_pylist(out, schema=_SKETCH_ARROW)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_SKETCH_ARROW)
                kept[r].clear()

        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                _, _, a, b, *_ = _windows(hasher, data, offsets, k)
                if len(a):
                    for r in range(rows):
                        kept[r].append(_cells(a, b, r, bits))
                    n += len(a)
                if n >= FLUSH_WINDOWS:
                    yield from flush()
                    n = 0
        if n:
            yield from flush()
    return run


def _merge_udf(batches):
    """Rows sorted by (row, slice): the cells hit more than once in all."""
    key, once, twice = None, None, None

    def result():
        return pa.RecordBatch.from_pylist(
            [{"row": key[0], "slice": key[1], "kind": 2,
              "bits": zstandard.compress(twice.tobytes(), 1)}], schema=_SKETCH_ARROW)

    for batch in batches:
        for x in batch.to_pylist():
            if (x["row"], x["slice"]) != key:
                if key is not None:
                    yield result()
                key = (x["row"], x["slice"])
                once, twice = np.zeros(1 << SLICE_BITS - 3, np.uint8), np.zeros(1 << SLICE_BITS - 3, np.uint8)
            hit = _unpacked(x["bits"])
            if x["kind"] == 2:
                twice |= hit
            else:
                twice |= once & hit
                once |= hit
    if key is not None:
        yield result()


def repeated_cells(texts: DataFrame, k: int, rows: int, bits: int) -> bytes:
    """The merged sketch: one bit a cell, hash rows one after another, set
    where more than one window hit the cell."""
    parts = texts.select("text").mapInArrow(_sketch_udf(k, rows, bits), SKETCH_TYPE)
    merged = (parts.repartition(shuffle_partitions(texts), "row", "slice")
              .sortWithinPartitions("row", "slice").mapInArrow(_merge_udf, SKETCH_TYPE))
    sketch = np.zeros((rows, 1 << bits - SLICE_BITS, 1 << SLICE_BITS - 3), np.uint8)
    # at most rows * 2**bits / 8 bytes, fixed by the parameters
    for x in merged.toLocalIterator():
        sketch[x["row"], x["slice"]] = np.frombuffer(zstandard.decompress(bytes(x["bits"])), np.uint8)
    return sketch.tobytes()


class _Suspects:
    """Looks windows up in the merged sketch."""

    def __init__(self, sketch: bytes, rows: int, bits: int):
        self.bits, self.rows = bits, rows
        self.sketch = np.frombuffer(sketch, np.uint8).reshape(rows, -1)

    def mask(self, a, b) -> np.ndarray:
        out = np.ones(len(a), bool)
        for r in range(self.rows):
            at = np.flatnonzero(out)
            c = _cells(a[at], b[at], r, self.bits)
            out[at] = (self.sketch[r][c >> np.uint32(3)] >> (7 - (c & np.uint32(7))).astype(np.uint8)) & 1 == 1
        return out


def _suspects_udf(sketch, k: int, rows: int, bits: int):
    def run(batches):
        hasher, look = WordHasher(), _Suspects(sketch.value, rows, bits)
        for batch in batches:
            ids, hashes = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            null = np.asarray(batch.column(1).is_null())
            for first, data, offsets in text_chunks(batch.column(0)):
                row, pos, a, b, *_ = _windows(hasher, data, offsets, k)
                at = np.flatnonzero(look.mask(a, b))
                if len(at):
                    r = row[at] + first
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[at].view(np.int64)), pa.array((b[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                         pa.array(ids[r].astype(np.int64) if not null.any() else
                                  np.where(null[r], 0, ids[r]).astype(np.int64), mask=null[r]),
                         pa.array((hashes[r].astype(np.int64) << 32) | pos[at])],
                        names=["a", "b", "doc_id", "place"])
    return run


def _pack_udf(batches):
    """Texts compressed one by one: they cross the shuffle once."""
    z = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in batches:
        raw, off = text_buffer(batch.column(0))
        view = memoryview(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array([z.compress(view[s:e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist())], pa.binary()),
             batch.column(1), batch.column(2)], names=["packed", "doc_id", "text_hash"])


def _remove_udf(sketch, k: int, rows: int, bits: int, with_text: bool):
    def run(batches):
        hasher, look = WordHasher(), _Suspects(sketch.value, rows, bits)
        unpack = zstandard.ZstdDecompressor().decompress

        def parts(batch):
            """Runs of rows of about a chunk's size, unpacked."""
            texts, size, first = [], 0, 0
            for i, x in enumerate(batch.column(0)):
                texts.append(unpack(x.as_py()))
                size += len(texts[-1])
                if size >= CHUNK_BYTES or i + 1 == batch.num_rows:
                    yield first, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
                    texts, size, first = [], 0, i + 1

        for batch in batches:
            unique = batch.column(2)
            for first, data, offsets in parts(batch):
                row, pos, a, b, n_words, starts_at, starts, ends = _windows(hasher, data, offsets, k)
                hit = look.mask(a, b)
                n = len(n_words)
                mine = unique.slice(first, n)
                window_at = starts_at[row] + pos  # number of the window's first word in the chunk
                edge = np.zeros(int(n_words.sum()) + 1, np.int32)
                at = window_at[hit]
                edge[at] += 1
                off = np.concatenate([[0], np.cumsum([0 if v is None else len(v) for v in mine.to_pylist()])]) \
                    if mine.null_count < n else None
                if off is not None:
                    flat = mine.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    edge[np.repeat(starts_at[:-1], np.diff(off)) + flat] -= 1
                open_ = edge.copy()
                open_[k:] -= edge[:-k]
                removed = np.cumsum(open_[:-1]) > 0
                counts = np.add.reduceat(np.append(removed, False).astype(np.int64), starts_at[:-1]) \
                    if n else np.zeros(0, np.int64)
                counts[n_words == 0] = 0
                raw, sha, texts = data.tobytes(), [], []
                for i in range(n):
                    lo, hi = starts_at[i], starts_at[i + 1]
                    if counts[i] == 0:
                        kept = b" ".join(raw[offsets[i]:offsets[i + 1]].split())
                    else:
                        keep = np.flatnonzero(~removed[lo:hi]) + lo
                        kept = b" ".join([raw[starts[j]:ends[j]] for j in keep])
                    sha.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        texts.append(kept.decode("utf-8", "replace"))
                columns = [batch.column(1).slice(first, n), pa.array(n_words.astype(np.int64)),
                           pa.array(counts), pa.array(sha, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(texts, pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def remove_repeated_passages(docs: DataFrame, k: int = 35, rows: int = 3, max_bits: int = 28,
                             with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` long, ``text``): ``doc_id``,
    ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by
    one space, UTF-8) and, if asked, ``kept_text``.

    A null text has no words. Texts under ``k`` words lose nothing. A repeated
    row repeats all its windows, so each of its copies loses all words (if it
    has ``k``). A null ``doc_id`` is kept as it is. Other columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max_bits, max(SLICE_BITS, math.ceil(math.log2(max(1.0, n_bytes / 7 * 2)))))
    sketch = spark.sparkContext.broadcast(repeated_cells(texts, k, rows, bits))
    keyed = texts.withColumn("text_hash", F.hash("text"))
    suspects = keyed.select("text", "doc_id", "text_hash").mapInArrow(
        _suspects_udf(sketch, k, rows, bits), "a long, b int, doc_id long, place long")
    # a window counted once belongs to one row, so min() gives that row; place
    # is the row's text hash and the window's position
    unique = (suspects.groupBy("a", "b")
              .agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"),
                   F.min("place").alias("place"))
              .where("n = 1")
              .groupBy(F.col("doc_id").alias("u_id"), F.shiftright("place", 32).cast("int").alias("u_hash"))
              .agg(F.collect_list(F.col("place").bitwiseAND(0x7FFFFFFF).cast("int")).alias("unique_at")))
    packed = keyed.select("text", "doc_id", "text_hash").mapInArrow(
        _pack_udf, "packed binary, doc_id long, text_hash int")
    joined = packed.join(unique, F.col("doc_id").eqNullSafe(F.col("u_id"))
                        & (F.col("text_hash") == F.col("u_hash")), "left")
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return joined.select("packed", "doc_id", "unique_at").mapInArrow(
        _remove_udf(sketch, k, rows, bits, with_text), out + (", kept_text string" if with_text else ""))
