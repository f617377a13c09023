"""Passages, near-duplicate documents and vectors against brute force."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bayline.llm import components, embedding_dedup, minhash_dedup, substring_dedup


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_passages(rows, k):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[j:j + k]) for _, w in words for j in range(len(w) - k + 1))
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - k + 1):
            if seen[tuple(w[j:j + k])] > 1:
                gone |= set(range(j, j + k))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


key = lambda r: tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("k,rows,bits", [(35, 3, 28), (35, 1, 20), (3, 2, 20)])
def test_passages(odd_docs, small_docs, k, rows, bits):
    docs = odd_docs.select("doc_id", "text").union(small_docs.select(F.col("doc_id") + 1000, "text"))
    got = [tuple(r) for r in substring_dedup.remove_repeated_passages(docs, k, rows, bits).collect()]
    assert sorted(got, key=key) == sorted(brute_passages(docs.collect(), k), key=key)


def test_crowded_sketch_loses_nothing(spark):
    """A sketch with far more windows than cells lets everything through."""
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(0), F.lit(60_000)), lambda x: F.concat(x, F.when(F.col("id") < 2, 0).otherwise(F.col("id"))))).alias("text"))
    got = {r.doc_id: r for r in substring_dedup.remove_repeated_passages(docs, 35, 1, 20).collect()}
    assert all(got[i].n_removed == 60_001 for i in (0, 1))
    assert all(got[i].n_removed == 0 for i in range(2, 30))


def test_no_passages(no_docs):
    assert substring_dedup.remove_repeated_passages(no_docs).collect() == []


def brute_near(rows, k, percent):
    sets, ids = {}, []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
        ids.append(i)
    known = sorted(i for i in sets if i is not None)
    links = []
    for n, a in enumerate(known):
        for b in known[:n]:
            for x in sets[a]:
                for y in sets[b]:
                    both = len(x & y)
                    if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                        links.append((a, b))
    return sets, roots(known, links)


@pytest.mark.parametrize("k", [2, 5])
def test_near_documents(odd_docs, small_docs, k):
    docs = odd_docs.select("doc_id", "text").union(small_docs.select(F.col("doc_id") + 1000, "text"))
    sets, root = brute_near(docs.collect(), k, 80)
    for r in minhash_dedup.near_duplicates(odd_docs.unionByName(
            small_docs.withColumn("doc_id", F.col("doc_id") + 1000), True), k).collect():
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        assert r.component_id == root.get(r.doc_id)
        assert r.kept == (None if r.doc_id is None else root[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("block", [8, 1024])
def test_groups_around_the_threshold(spark, block):
    """Near copies of near copies: buckets whose members the star around the
    smallest doesn't join, searched in full, whatever the blocks' size."""
    r = np.random.default_rng(0)
    rows, base = [], [[f"w{g}x{j}" for j in range(60)] for g in range(6)]
    for n in range(240):
        w = list(base[n % 6])
        for j in r.choice(60, r.integers(0, 7), replace=False):
            w[j] = f"n{r.integers(4)}y{j}"
        rows.append((n, " ".join(w)))
    _, root = brute_near(rows, 2, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in minhash_dedup.near_duplicates(docs, 2, block=block).collect()}
    same = sum(got[i] == root[i] for i in root)
    assert all(got[i] >= root[i] for i in root) and same >= 0.99 * len(root)


def test_different_texts_of_one_document(spark):
    """Rows that share a doc_id link through each of their texts."""
    t = [[f"{c}{j}" for j in range(60)] for c in "abcdef"]
    near = lambda w: " ".join([*w[:-1], "zz"])
    a, b, c, d, e, f = map(" ".join, t)
    rows = [(10, a), (10, b), (11, near(t[0])), (12, near(t[1])),  # near, through either text
            (20, c), (30, c), (30, d), (31, d),  # equal, through classes of two smallest ids
            (40, e), (40, e), (41, f), (41, None)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == {10: 10, 11: 10, 12: 10, 20: 20, 30: 20, 31: 20, 40: 40, 41: 41}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_no_documents(no_docs, odd_docs):
    assert minhash_dedup.near_duplicates(no_docs).collect() == []
    left = minhash_dedup.without_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]


def test_components(spark):
    r = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = {x.node: x.component for x in components.connected_components(
        spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert got == {i: want[i] for i in got}
    assert {i for p in links for i in p if p[0] != p[1]} == set(got)


def brute_vectors(rows, at):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, n = [], Counter()
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= at:
                links.append((good[a][0], good[b][0]))
                n[good[a][0]] += 1
                n[good[b][0]] += 1
    return n, roots({i for i, _ in rows if i is not None}, links)


def test_vectors(spark):
    r = np.random.default_rng(1)
    centre = r.normal(size=(40, 16))
    rows = [(int(i), [float(x) for x in centre[i % 40] + r.normal(size=16) * r.choice([0.02, 0.15, 0.4])]) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(30)] + [(700, [2 * x for x in rows[0][1]]), (701, [-x for x in rows[0][1]])]
    rows += [(801, None), (802, []), (803, [0.0] * 16), (804, [float("nan")] * 16), (805, [float("inf")] * 16),
             (806, [None, 1.0]), (807, [1.0, 2.0]), (808, [2.0, 4.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, id int").repartition(4)
    n, root = brute_vectors(rows, 0.9)
    got = embedding_dedup.near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    total = sum(n.values())
    assert sum(x.n_links for x in got if x.vec_id is not None) >= 0.97 * total
    for x in got:
        if x.vec_id is None:
            assert (x.component_id, x.kept) == (None, None)
        else:
            assert x.n_links <= n[x.vec_id] and x.component_id == root[x.vec_id] and x.kept == (x.vec_id == root[x.vec_id])
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).collect() == []


def test_vectors_that_share_an_id(spark):
    """One id on several vectors: each row has the links of its own vector."""
    r = np.random.default_rng(8)
    base = r.normal(size=(40, 24))
    near = lambda i: base[i] + 0.02 * r.normal(size=24)
    rows = [(5, base[0]), (5, base[1]), (6, near(0)), (7, near(1)), (5, base[1]), (2, near(1)), (9, base[2]), (9, near(3)), (8, base[3])]
    rows += [(int(i) % 7, near(int(i) % 20)) for i in range(4, 200)]
    rows = [(i, [float(y) for y in x]) for i, x in rows]
    unit = embedding_dedup._unit(np.array([x for _, x in rows]))
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    root = roots(range(len(rows)), list(zip(a.tolist(), b.tolist())))
    links = np.bincount(np.concatenate([a, b]), minlength=len(rows))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root[k]] = min(i, least.get(root[k], i))
    want = sorted((i, int(links[k]), least[root[k]], i == least[root[k]]) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicate_vectors(df, target_recall=0.9999)
    assert sorted(tuple(x) for x in got.select("vec_id", "n_links", "component_id", "kept").collect()) == want


def test_visits_and_blocks_are_symmetric():
    r = np.random.default_rng(2)
    x = embedding_dedup._unit(r.normal(size=(3_000, 16)))
    grid = embedding_dedup.fit_grid(x, 100_000, 0.9, 0.97)
    own, row, cell = grid.visits(x)
    assert {(i, c) for i, c in enumerate(own)} <= set(zip(row.tolist(), cell.tolist()))
    some = r.integers(0, 3_000, 5_000)
    told = set(zip(row.tolist(), cell.tolist()))
    cells = own[r.integers(0, 3_000, 5_000)]
    assert [(int(a), int(b)) in told for a, b in zip(some, cells)] == grid.visited(x[some], cells).tolist()


def test_block_of_near_copies_takes_little_memory():
    """All pairs of a block link: they aren't held with their vectors."""
    r, n, dim = np.random.default_rng(4), 1_000, 64
    x = embedding_dedup._unit(r.normal(size=dim) + 0.1 * r.normal(size=(n, dim)))
    grid = embedding_dedup.fit_grid(x, n, 0.9, 0.97)
    own = grid.visits(x)[0]
    two = lambda c: np.concatenate([c, c])
    zero = np.zeros(2 * n, np.int32)
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * n * dim + 1, dim, dtype=np.int32)), pa.array(two(x).ravel()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (zero, zero, zero, np.repeat(np.array([0, 1], np.int8), n), two(own).astype(np.int32),
                               two(np.arange(n)), np.ones(2 * n, np.int64))] + [vectors],
        names=["cell", "ib", "pb", "kind", "own", "id", "size", "vector"])
    tracemalloc.start()
    out = pa.Table.from_batches(list(embedding_dedup._block_udf(grid, dim, 0.9)(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    got = Counter()
    for i, k in zip(out["id"].to_pylist(), out["links"].to_pylist()):
        got[i] += k
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    back = np.stack([grid.visited(x, np.full(n, c)) for c in own], 1)  # does i visit the visitor's cell
    want = near.sum(1) + (near & ~back).sum(1)
    assert near.mean() > 0.9 and [got[i] for i in range(n)] == want.tolist() and set(out["root"].to_pylist()) == {0}


@pytest.mark.parametrize("dim,bits", [(1, 4), (3, 4), (7, 8), (64, 4), (64, 8), (300, 4)])
def test_codes_bound_the_cosine(dim, bits):
    r = np.random.default_rng(dim)
    x = r.normal(size=(300, dim))
    x[:50, 0] *= 50
    x[50:150] = x[:100] + 0.05 * r.normal(size=(100, dim))
    x[150:160] = -x[:10]
    x = embedding_dedup._unit(x)
    code = embedding_dedup.fit_code(x, 0.9)
    code = embedding_dedup.Code(code.order, code.turns, (0.335 if bits == 4 else 0.031) / np.sqrt(dim), bits)
    packed = code.encode(x)
    assert packed.shape[1] == -(-dim * bits // 8) + 2
    visitor, index = code.decode(packed)
    assert (visitor @ index.T >= x @ x.T - code.slack()).all()


@pytest.mark.parametrize("kind,clash", [("float", False), ("double", True)])
def test_vectors_in_many_blocks(spark, monkeypatch, kind, clash):
    """Cells split in blocks and tiles, one large group of near copies, equal
    vectors but for the sign of zero, keys of vectors that clash."""
    for name, value in (("BLOCK", 16), ("VISITORS", 2), ("TILE", 100), ("PACK", 3_000), ("CELL_ROWS", 20)):
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    if clash:
        monkeypatch.setattr(embedding_dedup, "_mark", lambda vector: F.size(vector).cast("long"))
    r = np.random.default_rng(9)
    base = r.normal(size=(60, 20))
    x = np.concatenate([base[r.integers(0, 60, 250)] + 0.05 * r.normal(size=(250, 20)), base[0] + 0.05 * r.normal(size=(120, 20))])
    x[:, 7] = 0.0
    x = np.concatenate([x, x[:30], x[:30]]).astype(np.float32)
    x[-30:, 7] = -0.0
    rows = [(int(i), [float(y) for y in v]) for i, v in zip(r.permutation(len(x)), x)]
    n, root = brute_vectors(rows, 0.9)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    got = embedding_dedup.near_duplicate_vectors(df, target_recall=0.9999).collect()
    assert sorted(map(tuple, got)) == sorted((i, n[i], root[i], root[i] == i) for i, _ in rows)
