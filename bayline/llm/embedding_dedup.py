"""Near-duplicate vectors by an inverted multi-index.

Vectors of unit length are split in two halves, each with a codebook of its
own; the pairs of codewords form a grid of cells. A vector is indexed in its
nearest cell and visits cells in the order of its distance to them, the sum of
the two halves' squared distances, until a margin beyond its nearest cell.
The margin is set for a target recall: the share of neighbours lying exactly at
the threshold, in random directions from a sample, whose cell is visited.
Closer neighbours are met more often, and a pair is found if either vector
visits the other's cell. Every meeting is verified by the cosine in doubles.

Equal vectors are one class. A cell's rows and visitors meet in blocks of
bounded size, as matrix products, twice. First they meet as short codes, sent
many to a row, whose products bound the cosine from above: vectors that meet
none near enough go no further, and no link is lost. The others meet again in
full. A block then gives counts per vector and the links of a spanning forest,
never all pairs; its products are made a tile at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.components import connected_components
from bayline.llm.staging import shuffle_partitions, staged, within_small_batches

SAMPLE, MIN_WORDS, MAX_WORDS, CELL_ROWS = 20_000, 4, 1024, 2_000
# rows of a cell in a block, visitors to one row of them, products in a tile,
# and bytes of codes in a batch
BLOCK, VISITORS, TILE, PACK = 4_096, 4, 1 << 20, 8 << 20
# what goes with a code: its vector and the vector's own cell
HEAD = np.dtype([("id", "<i8"), ("own", "<i4")])


@dataclass
class Grid:
    """Codebooks of the two halves and the margin of the traversal."""

    first: np.ndarray
    second: np.ndarray
    margin: float

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of unit vectors' halves to the codewords."""
        h = self.first.shape[1]
        return tuple((y * y).sum(1)[:, None] + (c * c).sum(1) - 2 * (y @ c.T)
                     for y, c in ((x[:, :h], self.first), (x[:, h:], self.second)))

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(own cell, row, visited cell)``: codewords of the first half in
        order of distance, each with the second half's codewords that are near
        enough, until none is."""
        d1, d2 = self.distances(x)
        k2 = d2.shape[1]
        own = d1.argmin(1) * k2 + d2.argmin(1)
        limit = d1.min(1) + d2.min(1) + self.margin
        order = d1.argsort(1, kind="stable")
        rows, cells, low2 = [], [], d2.min(1)
        live = np.arange(len(x))
        for i in range(d1.shape[1]):
            word = order[live, i]
            rest = limit[live] - d1[live, word]
            ok = rest >= low2[live]
            live, word, rest = live[ok], word[ok], rest[ok]
            if not len(live):
                break
            r, w2 = np.nonzero(d2[live] <= rest[:, None])
            rows.append(live[r])
            cells.append(word[r] * k2 + w2)
        return own, np.concatenate(rows), np.concatenate(cells)

    def reached(self, d1: np.ndarray, d2: np.ndarray, r: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether row r[i], its distances given, visits cell i."""
        k2 = d2.shape[1]
        return d1[r, cells // k2] <= d1.min(1)[r] + d2.min(1)[r] + self.margin - d2[r, cells % k2]

    def visited(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether row i of ``x`` visits cell i."""
        return self.reached(*self.distances(x), np.arange(len(x)), cells)


@dataclass
class Code:
    """Short codes of unit vectors. A fixed rotation evens out the coordinates;
    each is kept in ``bits`` bits, as steps of a normal spread, with the length
    of what they leave out. A product of codes is no less than the cosine."""

    order: np.ndarray
    turns: list[np.ndarray]
    step: float
    bits: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        at = np.cumsum([0, *(len(t) for t in self.turns)])
        z = np.hstack([x[:, self.order[a:b]] @ t for (a, b), t in zip(pairwise(at), self.turns)])
        half = 1 << (self.bits - 1)
        q = np.clip(np.floor(z / self.step) + half, 0, 2 * half - 1)
        left = np.linalg.norm(z - (q - half + 0.5) * self.step, axis=1) + 1e-9
        short = left.astype(np.float16)
        short = np.where(short < left, np.nextafter(short, np.float16(np.inf)), short)
        q = q.astype(np.uint8)
        if self.bits == 4:
            q = np.pad(q, ((0, 0), (0, q.shape[1] % 2)))
            q = q[:, ::2] << 4 | q[:, 1::2]
        return np.hstack([q, short[:, None].view(np.uint8)])

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Factors of each code as a visitor and as an indexed vector."""
        q, left = codes[:, :-2], np.ascontiguousarray(codes[:, -2:]).view(np.float16).astype(np.float32)
        if self.bits == 4:
            q = np.stack([q >> 4, q & 15], 2).reshape(len(q), -1)[:, :len(self.order)]
        x = (q.astype(np.float32) + np.float32(0.5 - (1 << (self.bits - 1)))) * np.float32(self.step)
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x, size, left, left]), np.hstack([x, left, size, left])

    def slack(self) -> float:
        """More than the rounding of a product in single precision."""
        return 1e-6 + 3e-7 * (len(self.order) + 3)


def _codebook(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    """k-means; a codeword that loses all its rows stays where it is."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def fit_code(sample: np.ndarray, threshold: float) -> Code:
    """Four bits a coordinate, or eight where four would let through pairs of
    the sample that aren't near."""
    rng, dim = np.random.default_rng(6), sample.shape[1]
    order = rng.permutation(dim)
    turns = [np.linalg.qr(rng.normal(size=(n, n)))[0] for n in (min(256, dim - a) for a in range(0, dim, 256))]
    code = Code(order, turns, 0.335 / np.sqrt(dim), 4)
    x = sample[:1_500]
    visitor, index = code.decode(code.encode(x))
    extra = (visitor @ index.T >= threshold - code.slack()) & (x @ x.T < threshold)
    return code if extra.mean() <= 1e-5 else Code(order, turns, 0.031 / np.sqrt(dim), 8)


def fit_grid(sample: np.ndarray, n_vectors: int, threshold: float, target_recall: float) -> Grid:
    """Codebooks and margin from a bounded sample of unit vectors. Codebooks
    grow with the fourth root of the cells wanted: about ``CELL_ROWS`` vectors a
    cell, within ``MIN_WORDS`` and ``MAX_WORDS`` words a half."""
    rng = np.random.default_rng(5)
    k = 2 ** round(np.log2(max(1.0, n_vectors / CELL_ROWS)) / 2)
    k = int(min(max(k, MIN_WORDS), MAX_WORDS))
    h = max(1, sample.shape[1] // 2)
    grid = Grid(_codebook(sample[:, :h], k, rng), _codebook(sample[:, h:], k, rng), 0.0)
    x = sample[:4_000]
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(1)[:, None] * x
    u /= np.maximum(np.linalg.norm(u, axis=1), 1e-12)[:, None]
    y = threshold * x + np.sqrt(1 - threshold ** 2) * u
    (d1, d2), (e1, e2) = grid.distances(x), grid.distances(y)
    r = np.arange(len(x))
    over = d1[r, e1.argmin(1)] + d2[r, e2.argmin(1)] - d1.min(1) - d2.min(1)
    grid.margin = float(np.quantile(over, target_recall)) + 1e-9
    return grid


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _visits(batches, grid: Grid, dim: int, rows: int = 2_000) -> Iterator[tuple]:
    """``(batch, unit vectors, own cell, row, visited cell)`` of ``rows`` rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            x = _unit(_matrix(part.column("vector"), dim))
            yield part, x, *grid.visits(x)


def _tally_udf(grid: Grid, dim: int):
    """Rows and visitors of cells, as far as a task sees them."""
    def run(batches):
        n = np.zeros((2, len(grid.first) * len(grid.second)), np.int64)
        for _, _, own, _, cell in _visits(batches, grid, dim):
            np.add.at(n[0], own, 1)
            n[1] += np.bincount(cell, minlength=n.shape[1])
        cells = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(n[0, cells]), pa.array(n[1, cells])],
                                         names=["cell", "n_rows", "n_visitors"])
    return run


def _pack_udf(grid: Grid, code: Code, dim: int, ni: np.ndarray, nv: np.ndarray, pack: int, rows: int):
    """Each vector's code in its own cell (kind 0) and in each cell that it
    visits (kind 1), codes of one block in one row. ``ni``, ``nv``: blocks of
    rows and of visitors of each cell; nothing is sent to a cell without rows.
    ``rows`` vectors are looked at together."""
    def rows_of(held):
        ids, codes, own = (np.concatenate(c) for c in zip(*(h[:3] for h in held)))
        base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
        row = np.concatenate([r + b for b, h in zip(base, held) for r in (np.arange(len(h[0])), h[3])])
        cell = np.concatenate([c for h in held for c in (h[2], h[4])])
        kind = np.concatenate([np.full(len(c), k, np.int8) for h in held for k, c in ((0, h[2]), (1, h[4]))])
        mix = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32))[row]
        index = kind == 0
        many_i, many_v = np.maximum(ni[cell], 1), np.maximum(nv[cell], 1)
        mine = (mix % np.where(index, many_i, many_v).astype(np.uint64)).astype(np.int32)
        times = np.where(index, many_v, many_i)
        take = np.repeat(np.arange(len(row)), times)
        other = (np.arange(len(take)) - np.repeat(np.cumsum(times) - times, times)).astype(np.int32)
        row, cell, kind, mine, index = row[take], cell[take].astype(np.int32), kind[take], mine[take], index[take]
        ib, pb = np.where(index, mine, other), np.where(index, other, mine)
        by = np.lexsort((row, kind, pb, ib, cell))
        row, keys = row[by], [c[by] for c in (cell, ib, pb, kind)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in keys], axis=0)) + 1
        cuts = np.array([0, *cuts, len(row)], np.int64)
        heads = np.empty(len(ids), HEAD)
        heads["id"], heads["own"] = ids, own
        heads = heads.view(np.uint8).reshape(-1, HEAD.itemsize)
        # bytes of one place together: the high ones are much alike
        heads = [heads[row[a:b]].T.tobytes() for a, b in pairwise(cuts.tolist())]
        ends = pa.py_buffer((cuts * codes.shape[1]).astype(np.int32))
        packed = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, ends, pa.py_buffer(codes[row].tobytes())])
        return pa.RecordBatch.from_arrays([*(pa.array(c[cuts[:-1]]) for c in keys), pa.array(heads, pa.binary()), packed],
                                          names=["cell", "ib", "pb", "kind", "heads", "codes"])

    def run(batches):
        held, n = [], 0
        for part, x, own, row, cell in _visits(batches, grid, dim, rows):
            used = ni[cell] > 0
            held.append((part.column("id").to_numpy(), code.encode(x), own, row[used], cell[used]))
            n += (held[-1][1].shape[1] + HEAD.itemsize) * int(np.maximum(nv[own], 1).sum() + ni[held[-1][4]].sum())
            if n >= pack:
                yield rows_of(held)
                held, n = [], 0
        if held:
            yield rows_of(held)
    return run


def _groups(batches) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch]]:
    """Of rows sorted by (cell, ib, pb, kind): the indexed rows of a block, one
    list, with each batch of its visitors."""
    block, index = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "ib", "pb", "kind")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
            if block != (now := tuple(keys[:3, a].tolist())):
                block, index = now, []
            if keys[3, a] == 0:
                index.append(batch.slice(a, b - a))
            elif index:
                yield index, batch.slice(a, b - a)


def _meet_udf(code: Code, threshold: float, tile: int):
    """Rows of codes sorted by (cell, ib, pb, kind): the vectors that meet
    another one in a block whose cosine may be ``threshold`` or more."""
    def unpack(batch):
        for heads, codes in zip(batch.column("heads"), batch.column("codes")):
            heads = np.ascontiguousarray(np.frombuffer(heads.as_buffer(), np.uint8).reshape(HEAD.itemsize, -1).T).view(HEAD)[:, 0]
            yield heads["id"], heads["own"], np.frombuffer(codes.as_buffer(), np.uint8).reshape(len(heads), -1)

    def rows(part, kind, ids, own):
        cell, ib, pb = (pa.array(np.full(len(ids), part.column(c)[0].as_py(), np.int32)) for c in ("cell", "ib", "pb"))
        return pa.RecordBatch.from_arrays([cell, ib, pb, pa.array(np.full(len(ids), kind, np.int8)), pa.array(ids), pa.array(own)],
                                          names=["cell", "ib", "pb", "kind", "id", "own"])

    def run(batches):
        held = None
        for index, part in _groups(batches):
            if index is not held:
                held = index
                ids, own, codes = (np.concatenate(c) for c in zip(*(u for b in index for u in unpack(b))))
                by = ids.argsort()
                ids, own = ids[by], own[by]
                y = np.ascontiguousarray(code.decode(codes[by])[1].T)
                told = np.zeros(len(ids), bool)
            met = np.zeros(len(ids), bool)
            step = max(1, tile // len(ids))
            for vid, vown, codes in unpack(part):
                near = np.zeros(len(vid), bool)
                for a in range(0, len(vid), step):
                    hit = code.decode(codes[a:a + step])[0] @ y >= threshold - code.slack()
                    me = np.minimum(np.searchsorted(ids, vid[a:a + step]), len(ids) - 1)
                    at = np.flatnonzero(ids[me] == vid[a:a + step])
                    hit[at, me[at]] = False
                    near[a:a + step] = hit.any(1)
                    if near[a:a + step].any():
                        met |= hit.any(0)
                if near.any():
                    yield rows(part, 1, vid[near], vown[near])
            if (met & ~told).any():
                yield rows(part, 0, ids[met & ~told], own[met & ~told])
            told |= met
    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position linked, directly or not, to each of ``n`` positions."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_udf(grid: Grid, dim: int, threshold: float, tile: int = TILE):
    """Rows sorted by (cell, ib, pb, kind): counts and forest links of blocks."""
    col = lambda t, *names: [t.column(c).combine_chunks() for c in names]

    def same(x, y, p, i):
        """Whether the cosines of pairs are ``threshold`` or more, some pairs at a time."""
        n = max(1, tile // dim)
        return np.concatenate([np.empty(0, bool), *((x[p[a:a + n]] * y[i[a:a + n]]).sum(1) >= threshold for a in range(0, len(p), n))])

    def solve(y, y_ids, y_size, d1, d2, part):
        x_ids, x_size, own, x = col(part, "id", "size", "own", "vector")
        x_ids, x_size, own, x = x_ids.to_numpy(), x_size.to_numpy(), own.to_numpy(), _unit(_matrix(x, dim))
        n, ids = len(y), np.concatenate([y_ids, x_ids])
        uniq, place = np.unique(ids, return_inverse=True)
        root, hit, count = np.arange(len(uniq)), np.zeros(len(ids), bool), np.zeros(len(ids))
        step = max(1, tile // n)
        for at in range(0, len(x), step):
            cosine = x[at:at + step] @ y.T
            p, i = np.nonzero(cosine >= threshold - 1e-9)
            unsure = np.flatnonzero(cosine[p, i] < threshold + 1e-9)
            p += at
            ok = x_ids[p] != y_ids[i]
            ok[unsure] &= same(x, y, p[unsure], i[unsure])
            p, i = p[ok], i[ok]
            if not len(p):
                continue
            # a link is counted for the visitor, and for the indexed vector if its
            # own traversal doesn't come to the visitor's cell
            back = ~grid.reached(d1, d2, i, own[p])
            count += np.bincount(n + p, y_size[i], len(ids))
            count += np.bincount(i[back], x_size[p[back]], len(ids))
            root = _forest(root[place[n + p]], root[place[i]], len(uniq))[root]
            hit[n + p] = hit[i] = True
        if not hit.any():
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[hit]), pa.array(count[hit].astype(np.int64)), pa.array(uniq[root[place[hit]]])],
            names=["id", "links", "root"])

    def run(batches):
        held = None
        for index, part in _groups(batches):
            if index is not held:
                held = index
                ids, size, y = col(pa.Table.from_batches(index), "id", "size", "vector")
                y = _unit(_matrix(y, dim))
                block = y, ids.to_numpy(), size.to_numpy(), *grid.distances(y)
            if (out := solve(*block, pa.Table.from_batches([part]))) is not None:
                yield out
    return run


def _links(classes: DataFrame, dim: int, threshold: float, target_recall: float) -> DataFrame:
    """``(id, links, root)`` rows for classes (``id``, ``vector``, ``size``) of
    one dimension."""
    n = classes.count()
    share = F.pmod(F.xxhash64("vector", F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(1, n))) + 1
    first = [F.col("vec_id"), F.xxhash64("vector")]
    some = [r.vector for r in classes.where(share).orderBy(*first).limit(2 * SAMPLE).collect()]
    if not some:
        some = [r.vector for r in classes.orderBy(*first).limit(1).collect()]
    some = _unit(np.array(some, np.float64))
    grid, code = fit_grid(some, n, threshold, target_recall), fit_code(some, threshold)
    tally = (classes.mapInArrow(_tally_udf(grid, dim), "cell int, n_rows long, n_visitors long").groupBy("cell")
             .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_visitors").alias("n_visitors")).where("n_rows > 0").collect())
    # a block's vectors and their distances to the words are held at once
    block = max(1, min(BLOCK, (16 << 20) // (16 * max(dim, len(grid.first)))))
    ni, nv = np.zeros((2, len(grid.first) * len(grid.second)), np.int32)
    for r in tally:
        ni[r.cell], nv[r.cell] = -(-r.n_rows // block), -(-r.n_visitors // (block * VISITORS))
    sent = sum(r.n_visitors * int(ni[r.cell]) for r in tally) // n  # rows for a vector
    parts, key = shuffle_partitions(classes), ("cell", "ib", "pb")
    packs = classes.select("id", "vector").mapInArrow(
        _pack_udf(grid, code, dim, ni, nv, PACK, max(1, min(2_000, 400_000 // (1 + sent)))),
        "cell int, ib int, pb int, kind byte, heads binary, codes binary")
    near = packs.repartition(parts, *key).sortWithinPartitions(*key, "kind").mapInArrow(
        _meet_udf(code, threshold, TILE), "cell int, ib int, pb int, kind byte, id long, own int")
    # only vectors that meet a near one are sent in full
    rows = near.join(classes.select("id", "vector", "size"), "id")
    return rows.repartition(parts, *key).sortWithinPartitions(*key, "kind").mapInArrow(
        _block_udf(grid, dim, threshold, TILE), "id long, links long, root long")


def _mark(vector: str):
    """A short key of vectors; they are joined by it where no two share one."""
    return F.xxhash64(vector)


def near_duplicate_vectors(embeddings: DataFrame, threshold: float = 0.9, target_recall: float = 0.97) -> DataFrame:
    """Per row of ``embeddings`` (``vec_id`` long, ``embedding`` array):
    ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id``
    (smallest ``vec_id`` reachable by links, itself included), ``kept``
    (``vec_id = component_id``).

    Vectors link when their cosine is ``threshold`` or more. Null, empty and
    zero vectors and those with null or non-finite parts link with nothing, nor
    do vectors of different lengths. Repeated rows are vectors of their own
    that link with each other; rows that share a ``vec_id`` but not their
    vector are too, each with its own links and component. A null ``vec_id`` links with nothing; its
    component and ``kept`` are null. Other columns are ignored; an empty table
    gives an empty result.
    """
    # single precision is sent as such; cosines are of doubles
    single = embeddings.select("embedding").dtypes[0][1] == "array<float>"
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    sound = (F.col("vec_id").isNotNull() & (F.size("vector") > 0)
             & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("vector", lambda x: x != 0))
    v = v.withColumn("vector", F.when(F.coalesce(sound, F.lit(False)), F.col("vector")))
    # classes have numbers of their own, fixed by the write: two may share a vec_id
    classes = staged(v.where("vector is not null").groupBy("vector")
                     .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("size"))
                     .withColumn("id", F.monotonically_increasing_id()).withColumn("mark", _mark("vector")), "imi-classes")
    found = None
    with within_small_batches(embeddings.sparkSession):
        # one index for each length of vectors; a table has one as a rule
        for (dim,) in classes.select(F.size("vector")).distinct().orderBy(F.size("vector")).collect():
            part = _links(classes.where(F.size("vector") == dim), dim, threshold, target_recall)
            found = part if found is None else found.union(part)
        found = None if found is None else staged(found, "imi-links")
    if found is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.when(F.col("vec_id").isNotNull(), True).alias("kept"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = (connected_components(found.select("id", "root")).withColumnRenamed("node", "id")
            .join(classes.select("id", "vec_id"), "id"))
    least = comp.groupBy("component").agg(F.min("vec_id").alias("least"))
    comp = comp.join(least, "component").select("id", "least")
    key = "vector" if classes.groupBy("mark").count().where("count > 1").limit(1).count() else "mark"
    facts = (classes.join(counts, "id", "left").join(comp, "id", "left")
             .select(key, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("least", "vec_id").alias("component_id")))
    out = v.where("vector is not null").withColumn("mark", _mark("vector"))
    out = out.select("vec_id", key).join(facts, key).select("vec_id", "n_links", "component_id")
    rest = v.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
