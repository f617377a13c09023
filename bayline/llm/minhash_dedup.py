"""MinHash near-duplicate detection with tensored banding.

Two collections of ``m`` small hashes are made, each hash joining ``t``
minhashes. A table's key combines hash i of the first with hash j of the
second collection, so ``m * m`` tables of ``2 t`` rows come from only
``2 m t`` minhashes (the default: 64 tables from 32). A pair of Jaccard
similarity s is a candidate with probability ``(1 - (1 - s**t)**m)**2``:
0.9994 at 0.8 and more above. Every link is confirmed on the full shingle
sets, so nothing below the threshold links.

Links are needed only as far as they connect:

1. Texts with equal shingle sets are one class; classes are linked through
   their smallest ``doc_id``.
2. In each key's bucket every class is paired with the bucket's smallest
   (a grouped minimum, joined back); confirmed pairs give components.
3. Buckets that still hold more than one component are searched in full: all
   pairs of classes in different components, in blocks of ``block`` members,
   each pair only in the first key that it shares. A 1024-bit map of each set
   bounds the difference of two sets from below, so pairs that it rules out
   are surely under the threshold; the others are confirmed on full sets.

After step 3 no candidate pair joins two components unseen, whatever the size
of its bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.components import connected_components
from bayline.llm.staging import shuffle_partitions, small_batches, staged
from bayline.llm.words import WordHasher, mix64, text_chunks

MAP_BITS = 1024
SIGNATURE_TYPE = ("doc_id long, n_shingles long, set_a long, set_b long, left array<long>, "
                  "right array<long>, bits binary")


def _shingle_rows(hasher: WordHasher, data, offsets, k: int):
    """``(row, shingle)`` of a chunk, once each, sorted by row."""
    h, rows, *_ = hasher.words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(rows, minlength=n)
    seq = hasher.sequences(h, k)
    inside = rows[:len(seq)] == rows[k - 1:] if len(seq) else np.zeros(0, bool)
    row, val = rows[:len(seq)][inside], seq[inside]
    # fewer words than k: the whole sequence is the only shingle
    first = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.array([hasher.sequences(h[first[i]:first[i + 1]], count[i])[0] for i in short], np.uint64)
        row = np.concatenate([row, short])
        val = np.concatenate([val, mix64(whole + np.uint64(k) + count[short].astype(np.uint64))])
    order = np.lexsort((val, row))
    row, val = row[order], val[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (val[1:] != val[:-1])
    return row[new], val[new]


def _signature_udf(k: int, m: int, t: int):
    def run(batches):
        hasher = WordHasher(lower=True)
        mult = np.random.default_rng(7).integers(1, 1 << 63, 2 * m * t, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                n = len(offsets) - 1
                row, val = _shingle_rows(hasher, data, offsets, k)
                size = np.bincount(row, minlength=n)
                full = np.flatnonzero(size)
                begin = np.concatenate([[0], np.cumsum(size)])[:-1][full]
                sums = np.zeros((n, 2), np.uint64)
                groups = np.zeros((n, 2 * m), np.uint64)
                bits = np.zeros((n, MAP_BITS), bool)
                if len(full):
                    sums[full, 0] = np.add.reduceat(val, begin)
                    sums[full, 1] = np.add.reduceat(mix64(val ^ np.uint64(0x51ED270B27A1F3C5)), begin)
                    for g in range(2 * m):
                        key = np.full(len(full), g + 1, np.uint64)
                        for j in range(t):
                            low = np.minimum.reduceat(val * mult[g * t + j], begin)
                            key = mix64(key * np.uint64(_KEY_MULT) + low)
                        groups[full, g] = key
                    bits[row, val >> np.uint64(54)] = True
                packed = np.packbits(bits, axis=1)
                as_list = lambda x: pa.ListArray.from_arrays(
                    pa.array(np.arange(0, n * m + 1, m, dtype=np.int32)), pa.array(x.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(size.astype(np.int64)),
                     pa.array(np.ascontiguousarray(sums[:, 0]).view(np.int64)),
                     pa.array(np.ascontiguousarray(sums[:, 1]).view(np.int64)),
                     as_list(np.ascontiguousarray(groups[:, :m])), as_list(np.ascontiguousarray(groups[:, m:])),
                     pa.array([x.tobytes() for x in packed], pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "left", "right", "bits"])
    return run


_KEY_MULT = 0x2545F4914F6CDD1D


def _confirm_udf(k: int, percent: int):
    """Rows (a, b, text_a, text_b) whose sets reach the threshold."""
    def run(batches):
        hasher = WordHasher(lower=True)

        def sets(column):
            for _, data, offsets in text_chunks(column):
                row, val = _shingle_rows(hasher, data, offsets, k)
                at = np.searchsorted(row, np.arange(len(offsets)))
                for i in range(len(offsets) - 1):
                    yield val[at[i]:at[i + 1]]

        for batch in batches:
            keep = []
            for x, y in zip(sets(batch.column(2)), sets(batch.column(3))):
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(len(x) > 0 and len(y) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))
    return run


def _cross_udf(percent: int, m: int):
    """Pairs within a block, rows sorted by (key, bi, bj), whose members are in
    different components, that first meet in this key and that the bit maps
    don't rule out. All blocks of a batch are paired at once: row i with row
    i + d for d = 1, 2, ... while both are in one block."""
    def pairs(t: pa.Table):
        col = lambda c: t.column(c).combine_chunks()
        num = lambda c: col(c).to_numpy()
        key, bi, bj, side, ids, comp, size = map(num, ("key", "bi", "bj", "side", "id", "comp", "n_shingles"))
        ki, kj = num("ki"), num("kj")
        left, right = (col(c).flatten().to_numpy().reshape(-1, m) for c in ("left", "right"))
        maps = np.frombuffer(b"".join(col("bits").to_pylist()), np.uint64).reshape(-1, MAP_BITS // 64)
        i, d, out = np.arange(len(key)), 1, []
        while len(i := i[i + d < len(key)]):
            j = i + d
            same = (key[i] == key[j]) & (bi[i] == bi[j]) & (bj[i] == bj[j])
            i, j = i[same], j[same]
            ok = (comp[i] != comp[j]) & ((bi[i] == bj[i]) | (side[i] != side[j]))
            ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            x, y = i[ok], j[ok]
            if len(x):
                same_l, same_r = left[x] == left[y], right[x] == right[y]
                first = (same_l.argmax(1) == ki[x]) & (same_r.argmax(1) == kj[x])
                x, y = x[first], y[first]
                # similarity s needs |x delta y| <= (|x| + |y|) (1 - s) / (1 + s)
                apart = np.bitwise_count(maps[x] ^ maps[y]).sum(axis=1)
                near = apart * (100 + percent) <= (size[x] + size[y]) * (100 - percent)
                out.append((ids[x[near]], ids[y[near]]))
            d += 1
        a, b = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches):
        held = None  # the last block of the rows so far: it may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            ends = [t.column(c)[-1].as_py() for c in ("key", "bi", "bj")]
            last = np.ones(t.num_rows, bool)
            for c, v in zip(("key", "bi", "bj"), ends):
                last &= t.column(c).to_numpy() == v
            cut = int(np.flatnonzero(last)[0])
            held = t.slice(cut)
            if cut:
                yield pairs(t.slice(0, cut))
        if held is not None:
            yield pairs(held)
    return run


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, m: int = 8, t: int = 2,
                    block: int = 1024) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` long, ``text``): ``doc_id``,
    ``n_shingles``, ``component_id`` (smallest ``doc_id`` reachable by links,
    itself included), ``kept`` (``doc_id = component_id``).

    A text's set holds its distinct runs of ``shingle_words`` words after
    folding A-Z; with fewer words the whole sequence is the only shingle. Texts
    link when 100 * intersection >= ``percent`` * union. A null or empty text
    has an empty set and links with nothing. Rows of one ``doc_id`` count as
    one document: they share a component. A null ``doc_id`` links with
    nothing; its component and ``kept`` are null. Other columns are ignored;
    an empty table gives an empty result.
    """
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    sig = staged(texts.mapInArrow(_signature_udf(shingle_words, m, t), SIGNATURE_TYPE), "minhash")
    nodes = sig.where("doc_id is not null and n_shingles > 0")
    classes = nodes.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("id"))
    # one signature row for each class: that of its smallest document (rows of
    # one doc_id may be of several classes, which are one node below)
    reps = (nodes.join(classes.select(F.col("id").alias("doc_id"), "set_a", "set_b"),
                       ["doc_id", "set_a", "set_b"])
            .dropDuplicates(["doc_id", "set_a", "set_b", "n_shingles"])
            .select(F.col("doc_id").alias("id"), "n_shingles", "left", "right", "bits"))
    keys = reps.select(
        "id", F.explode(F.flatten(F.transform("left", lambda x, i: F.transform(
            F.col("right"), lambda y, j: F.struct(F.xxhash64(x, y, i, j).alias("key"),
                                                  i.alias("ki"), j.alias("kj")))))).alias("k"))
    keys = keys.select("id", F.col("k.key").alias("key"), F.col("k.ki").cast("byte").alias("ki"),
                       F.col("k.kj").cast("byte").alias("kj"))
    shared = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    buckets = staged(keys.join(shared.select("key", "hub"), "key"), "minhash-buckets")
    # documents that share a bucket, with their texts, each different one
    involved = buckets.select(F.col("id").alias("doc_id")).distinct()
    mark = F.xxhash64("text").alias("mark")
    met = staged(texts.join(involved, "doc_id").select("*", mark, F.hash("text").alias("mark_b"))
                 .dropDuplicates(["doc_id", "mark", "mark_b"]).drop("mark", "mark_b"), "minhash-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(met.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        both = with_a.join(met.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(
            _confirm_udf(shingle_words, percent), "a long, b long")

    stars = buckets.where("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = staged(confirmed(stars), "minhash-stars")
    comp = staged(connected_components(links), "minhash-comp")

    member = buckets.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "comp", F.coalesce("component", "id")).drop("component", "hub")
    mixed = (member.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select("key", F.ceil(F.col("n") / block).cast("int").alias("n_blocks")))
    placed = member.join(mixed, "key").withColumn("side", F.pmod(F.xxhash64("id"), "n_blocks").cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    placed = placed.select("key", "ki", "kj", "id", "comp", "side", F.least("side", "o").alias("bi"),
                           F.greatest("side", "o").alias("bj"))
    placed = placed.join(reps, "id")
    cross = (placed.repartition(shuffle_partitions(docs), "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
             .mapInArrow(_cross_udf(percent, m), "a long, b long"))
    more = confirmed(cross.distinct())
    in_class = nodes.join(classes, ["set_a", "set_b", "n_shingles"]).select("doc_id", "id")
    # a document's class representative, then the representative's component;
    # a document of several classes links their representatives
    ends = in_class.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    root = ends.where("doc_id <> lo").select("doc_id", F.col("lo").alias("id"))
    joins = in_class.join(ends.where("lo < hi"), "doc_id").where("lo < id").select("lo", "id").distinct()
    final = connected_components(comp.union(more).union(joins))
    out = (sig.select("doc_id", "n_shingles").join(root, "doc_id", "left")
           .withColumn("node", F.coalesce("id", "doc_id"))
           .join(final, "node", "left"))
    component = F.coalesce("component", "node").alias("component_id")
    return out.select("doc_id", "n_shingles", component,
                      (F.col("doc_id") == F.coalesce("component", "node")).alias("kept"))


def without_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, **how) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the
    smallest ``doc_id``; all columns kept. Rows equal in ``doc_id`` and text
    are one. Rows with a null ``doc_id`` stay, equal texts among them once."""
    gone = (near_duplicates(docs, shingle_words, percent, **how).where("not kept")
            .select(F.col("doc_id").alias("gone_id")).distinct())
    left = docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
    # hashed, so that sorting and comparing don't read the texts
    mark = "text_mark_of_near_duplicates"
    return left.withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark]).drop(mark)
