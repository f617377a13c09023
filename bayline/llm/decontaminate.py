"""Benchmark passages in documents, by latent semantic retrieval.

Texts are cut into blocks of ``BLOCK`` words; a passage is two blocks, so any
``BLOCK`` words in a row lie within one. Terms are the words of the benchmark.

1. One pass over all documents counts, per term, the blocks that hold it, and
   sums the product of the block-term matrix with its own transpose and a
   random matrix. With the counts as inverse document frequencies this is the
   sketch of a randomised SVD (the single-pass form for symmetric products),
   which gives the leading right singular vectors and values of the TF-IDF
   matrix; the sketch is as large as the vocabulary, not as the corpus.
2. A word's latent vector is its row of the singular vectors, each direction
   scaled to equal weight, at unit length: common words, which rule 4 counts
   like any other, then weigh as much as rare ones. An item's vector is the sum
   of its words'.
3. Retrieval is local to the item: of a run of passages only the words of the
   item are added up, and the run is a candidate if that vector's part along
   the item's is ``min_share`` of the item's and its cosine ``min_cosine`` or
   more. The text around a short item doesn't blur it. Nothing else is compared.
   The words are counted first, for all items at once: where they are too few
   for rule 4 in any order, nothing is weighed.
4. A candidate's surroundings, the passage and as many words as the item has on
   either side, are compared with the whole item by the longest common
   subsequence of words. ``exact`` of the item's words in order make a leak;
   from ``paraphrase`` on it is one if ``answer_share`` of the words of the
   item's answer are there too; and from ``loose`` on, with the answer, if some
   stretch as long as the item reaches ``same_sense``, in cosine and in length
   along the item's vector, over all terms of the benchmark: words replaced by
   others of the same use. The answer is the item's ``answer`` column or,
   without one, its last sentence.

The benchmark is the query set: its items are handled ``item_block`` at a
time, which bounds what the tasks are sent.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.staging import shuffle_partitions, small_batches
from bayline.llm.words import WordHasher, text_chunks

BLOCK, RANK, EXTRA, TERM_ROWS = 16, 64, 16, 64
CELLS = 1 << 23  # numbers in one table of the exact count


def _hasher() -> WordHasher:
    """Words of letters and digits (texts are lower-cased before)."""
    h = WordHasher()
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    h.space = ~word
    return h


def _hashes(hasher: WordHasher, text: str) -> np.ndarray:
    data = np.frombuffer(pc.utf8_lower(pa.scalar(text)).as_py().encode("utf-8", "replace"), np.uint8)
    return hasher.words(data, np.array([0, len(data)]))[0]


@dataclass
class Items:
    """A block of benchmark items: words as term numbers, and answers."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray  # sorted word hashes
    maybe: np.ndarray = field(default=None)

    def term_numbers(self, h: np.ndarray) -> np.ndarray:
        """Term of each word, -1 for words of no item."""
        out = np.full(len(h), -1, np.int32)
        at = np.flatnonzero(self.maybe[h >> np.uint64(48)])
        j = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        ok = self.terms[j] == h[at]
        out[at[ok]] = j[ok]
        return out


def load_items(rows: list) -> Items:
    """``rows`` of (item_id, text, answer or None); items without words are
    left out."""
    hasher, ids, words, answers = _hasher(), [], [], []
    for item_id, text, answer in rows:
        w = _hashes(hasher, text or "")
        if item_id is None or not len(w):
            continue
        if answer is None:
            sentences = [s for s in re.split(r"[.!?\n]+", text) if len(_hashes(hasher, s))]
            answer = sentences[-1]
        ids.append(item_id)
        words.append(w)
        answers.append(np.unique(_hashes(hasher, answer)))
    terms = np.unique(np.concatenate(words + answers)) if words else np.zeros(0, np.uint64)
    maybe = np.zeros(1 << 16, bool)
    maybe[terms >> np.uint64(48)] = True
    return Items(ids, [np.searchsorted(terms, w).astype(np.int32) for w in words],
                 [np.searchsorted(terms, a).astype(np.int32) for a in answers], terms, maybe)


def _blocks(rows: np.ndarray, n_rows: int):
    """``(block of each word, first word of each row, first block of each row)``."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])
    n_blocks = -(-count // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(n_blocks)])
    block = first_block[rows] + (np.arange(len(rows)) - first[rows]) // BLOCK
    return block, first, first_block


def _block_terms(term: np.ndarray, block: np.ndarray, n_blocks: int, none: int) -> np.ndarray:
    """Terms of each block, ``none`` where a word is no term."""
    out = np.full((n_blocks, BLOCK), none, np.int32)
    if len(term):
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        at = np.arange(len(term)) - np.repeat(first, np.diff(np.append(first, len(term))))
        out[block, at] = np.where(term < 0, none, term)
    return out


def _block_sums(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of ``table`` rows of each block's terms; its last row is zero."""
    out = table[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        out += table[rows[:, j]]
    return out


def _with_zero(table: np.ndarray) -> np.ndarray:
    return np.vstack([table, np.zeros((1, table.shape[1]), table.dtype)])


def _random(n: int, width: int) -> np.ndarray:
    return np.random.default_rng(29).standard_normal((n, width), np.float32)


def _sketch_udf(items: Items, width: int):
    """Per task and range of terms: blocks that hold each, and the sketch."""
    def run(batches):
        hasher, n = _hasher(), len(items.terms)
        omega, total, n_blocks = _with_zero(_random(n, width)), np.zeros((n, width + 1)), 0
        for batch in batches:
            for _, data, offsets in text_chunks(pc.utf8_lower(batch.column(0))):
                h, rows, *_ = hasher.words(data, offsets)
                block, _, first_block = _blocks(rows, len(offsets) - 1)
                n_blocks += int(first_block[-1])
                term = items.term_numbers(h)
                z = _block_sums(_block_terms(term, block, int(first_block[-1]), n), omega)
                at = np.flatnonzero(term >= 0)
                order = at[np.argsort(term[at], kind="stable")]
                t, b = term[order], block[order]
                if len(t):
                    begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                    total[t[begin], :width] += np.add.reduceat(z[b], begin, axis=0)
                once = np.ones(len(t), bool)
                once[1:] = (t[1:] != t[:-1]) | (b[1:] != b[:-1])
                total[:, width] += np.bincount(t[once], minlength=n)
        for k in range(0, n, TERM_ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k // TERM_ROWS], pa.int32()), pa.array([n_blocks], pa.int64()),
                 pa.array([total[k:k + TERM_ROWS].tobytes()], pa.binary())], names=["part", "n_blocks", "sums"])
    return run


def _add_udf(batches):
    part, blocks, sums = None, 0, None
    out = lambda: pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([blocks], pa.int64()), pa.array([sums.tobytes()], pa.binary())],
        names=["part", "n_blocks", "sums"])
    for batch in batches:
        for p, b, s in zip(*(c.to_pylist() for c in batch.columns)):
            new = np.frombuffer(s)
            if p == part:
                sums, blocks = sums + new, blocks + b
                continue
            if part is not None:
                yield out()
            part, blocks, sums = p, b, new
    if part is not None:
        yield out()


@dataclass
class LatentSpace:
    """Unit vectors of the terms, and the items' vectors."""

    words: np.ndarray  # (terms, rank)
    items: np.ndarray  # (items, rank)


def fit_latent(texts: DataFrame, items: Items, rank: int = RANK) -> LatentSpace:
    """The latent space of all ``texts`` (one column ``text``)."""
    width, n = rank + EXTRA, len(items.terms)
    kind = "part int, n_blocks long, sums binary"
    added = (texts.mapInArrow(_sketch_udf(items, width), kind).repartition(shuffle_partitions(texts), "part")
             .sortWithinPartitions("part").mapInArrow(_add_udf, kind))
    total, n_blocks = np.zeros((n, width + 1)), 1
    for r in added.toLocalIterator():  # as many rows as the block's vocabulary has ranges
        rows = np.frombuffer(bytes(r.sums)).reshape(-1, width + 1)
        total[r.part * TERM_ROWS:r.part * TERM_ROWS + len(rows)] = rows
        n_blocks = r.n_blocks
    return latent_space(items, total, n_blocks, rank)


def latent_space(items: Items, total: np.ndarray, n_blocks: int, rank: int = RANK) -> LatentSpace:
    """The latent space from a corpus's sketch: ``total`` holds, per term, the
    sums of the sketch and, last, the number of blocks with the term."""
    n, width = len(items.terms), total.shape[1] - 1
    idf = np.log((1 + n_blocks) / (1 + total[:, width])) + 0.1
    # M = D A'A D; its sketch for the test matrix D^-1 Omega is D A'A Omega
    y, test = idf[:, None] * total[:, :width], _random(n, width) / idf[:, None]
    shift = 1e-6 * max(1.0, np.linalg.norm(y))
    y += shift * test
    core = test.T @ y
    val, vec = np.linalg.eigh((core + core.T) / 2)
    good = val > 1e-9 * max(val.max(), 1e-300)
    u, s, _ = np.linalg.svd(y @ (vec[:, good] / np.sqrt(val[good])), full_matrices=False)
    u, s = u[:, :rank], np.maximum(s[:rank], 1e-12)
    words = idf[:, None] * u / s
    norm = np.linalg.norm(words, axis=1, keepdims=True)
    words = np.divide(words, norm, out=np.zeros_like(words), where=norm > 1e-12).astype(np.float32)
    # a term that no text holds has no direction of its own: a random one, so
    # that its absence counts
    lost = np.flatnonzero(norm[:, 0] <= 1e-12)
    if len(lost):
        far = _random(n, words.shape[1])[lost]
        words[lost] = far / np.linalg.norm(far, axis=1, keepdims=True)
    return LatentSpace(words, np.array([words[w].sum(0) for w in items.words]))


def _places(a: np.ndarray) -> dict[int, int]:
    """Bits of the places of each word."""
    place: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        place[x] = place.get(x, 0) | 1 << i
    return place


def lcs_length(a: np.ndarray, b: np.ndarray, place: dict[int, int] | None = None) -> int:
    """Words in the longest common subsequence (bit-parallel over ``a``)."""
    place = _places(a) if place is None else place
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        if y in place:
            u = v & place[y]
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


@dataclass
class Rules:
    min_share: float = 0.3
    min_cosine: float = 0.5
    exact: float = 0.8
    paraphrase: float = 0.6
    loose: float = 0.4
    same_sense: float = 0.7
    answer_share: float = 0.8


class Finder:
    """Leaks in a chunk of texts."""

    def __init__(self, items: Items, space: LatentSpace, rules: Rules):
        self.items, self.space, self.rules, self.hasher = items, space, rules, _hasher()
        # items by the blocks that they reach on either side of a passage, up
        # to a power of two; by term what an item holds of it: the times it is
        # there, and in the bits above whether its answer has it
        reach = np.array([max(4, 1 << (-(-len(w) // BLOCK) - 1).bit_length()) for w in items.words])
        self.square = np.maximum((space.items ** 2).sum(1), 1e-30)
        self.groups, self.places, self.own = [], [_places(w) for w in items.words], []
        for w in items.words:
            uniq, times = np.unique(w, return_counts=True)
            self.own.append((uniq, times[:, None] * space.words[uniq]))
        self.size = np.array([len(w) for w in items.words])
        self.answer_size = np.array([len(a) for a in items.answers])
        most = max(self.size.max(initial=0), self.answer_size.max(initial=0))
        self.bits, kind = (16, np.int32) if most < 1 << 15 else (32, np.int64)
        for g in np.unique(reach).tolist():
            members = np.flatnonzero(reach == g)
            held = np.zeros((len(items.terms), len(members)), kind)
            for j, i in enumerate(members):
                held[:, j] = np.bincount(items.words[i], minlength=len(items.terms))
                held[items.answers[i], j] += 1 << self.bits
            self.groups.append((g, members, held))
        # of each item its terms, with a place for words of no item
        self.of_item = np.zeros((len(items.words), len(items.terms) + 1), bool)
        for i, w in enumerate(items.words):
            self.of_item[i, w] = True

    def retrieved(self, term: np.ndarray, rows: np.ndarray, block: np.ndarray, first: np.ndarray,
                  first_block: np.ndarray) -> list[tuple[int, int]]:
        """``(passage, item)`` of all candidates. Passages are taken ``span`` at
        a time with all their surroundings, which no single one exceeds."""
        at, out = np.flatnonzero(term >= 0), []
        t, r, n_terms = term[at].astype(np.int64), rows[at], len(self.items.terms)
        local = block[at] - first_block[r]
        for g, members, held in self.groups if len(t) else ():
            span = 2 * g + 2
            n_spans = -(-np.diff(first_block) // span)
            first_span = np.concatenate([[0], np.cumsum(n_spans)])
            # a word is in the surroundings of two spans at most
            lo, hi = np.maximum(-(-(local - g) // span) - 1, 0), np.minimum((local + g) // span, n_spans[r] - 1)
            two = lo < hi
            code = np.sort(np.concatenate([first_span[r] + lo, (first_span[r] + hi)[two]]) * n_terms
                           + np.concatenate([t, t[two]]))
            once = np.ones(len(code), bool)
            once[1:] = code[1:] != code[:-1]
            s, x = np.divmod(code[once], n_terms)
            begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            size, s = np.diff(np.append(begin, len(x))), s[begin]
            order = np.argsort(-size, kind="stable")
            begin, size, s = begin[order], size[order], s[order]
            row_of = np.searchsorted(first_span, s, "right") - 1
            step = max(1, CELLS // len(s))
            for k in range(0, len(members), step):
                part = np.ascontiguousarray(held[:, k:k + step])
                total = part[x[begin]]
                for j in range(1, int(size[0])):
                    live = int(np.searchsorted(-size, -j))
                    total[:live] += part[x[begin[:live] + j]]
                mark, last = np.zeros(n_terms, bool), -1
                for i, q in zip(*(z.tolist() for z in np.nonzero(self.enough(total, members[k:k + step])))):
                    if i != last:
                        mark[:] = False
                        mark[x[begin[i]:begin[i] + size[i]]] = True
                        last = i
                    row, item = int(row_of[i]), int(members[k + q])
                    if not self.near(item, mark):
                        continue
                    p0 = int(first_block[row]) + (int(s[i]) - int(first_span[row])) * span
                    p1 = min(p0 + span, int(first_block[row + 1]))
                    if self._common(item, term, first, first_block, row, p0, p1)[0] >= self.rules.loose * len(self.items.words[item]):
                        out += [(p, item) for p in range(p0, p1)]
        return sorted(out)

    def enough(self, held: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Whether of the items ``members`` so many words are held as rule 4
        asks for, in any order."""
        n, answer, rules = held & ((1 << self.bits) - 1), held >> self.bits, self.rules
        size = self.size[members]
        return (n >= rules.loose * size) & ((n >= rules.exact * size)
                                            | (answer >= rules.answer_share * self.answer_size[members]))

    def near(self, item: int, mark: np.ndarray) -> bool:
        """Whether the sum of those of the item's words that are marked has
        cosine ``min_cosine`` with the item's vector and a part along it of
        ``min_share``."""
        (uniq, vectors), to, rules = self.own[item], self.space.items[item], self.rules
        v = vectors[mark[uniq]].sum(0)
        along = v @ to
        return bool(along >= rules.min_share * self.square[item]
                    and along >= rules.min_cosine * max(np.linalg.norm(v) * np.linalg.norm(to), 1e-30))

    def sense(self, item: int, region: np.ndarray) -> float:
        """How far a stretch of the item's length says the same, by all terms of
        the benchmark: the smaller of its cosine with the item and its part along
        the item's vector, as a share of that; words of no item say nothing."""
        n, to = len(self.items.words[item]), self.space.items[item]
        v = np.where((region >= 0)[:, None], self.space.words[region], 0).astype(np.float64)
        total = np.vstack([np.zeros(v.shape[1]), np.cumsum(v, 0)])
        part = total[n:] - total[:-n] if len(region) > n else total[-1:]
        along, size = part @ to, max(np.linalg.norm(to), 1e-30)
        return float((along / size / np.maximum(np.linalg.norm(part, axis=1), size)).max())

    def _common(self, item: int, term, first, first_block, row: int, p0: int, p1: int) -> tuple[int, np.ndarray]:
        """Common words of an item and the surroundings of passages ``p0`` to
        ``p1 - 1`` of a row, and these surroundings."""
        w, base = self.items.words[item], int(first[row]) - int(first_block[row]) * BLOCK
        region = term[max(int(first[row]), base + p0 * BLOCK - len(w)):
                      min(int(first[row + 1]), base + (p1 + 1) * BLOCK + len(w))]
        return lcs_length(w, region[self.of_item[item][region]], self.places[item]), region

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, bool]]:
        """``{(row, item): (common words, paraphrase)}``."""
        items, rules = self.items, self.rules
        h, rows, *_ = self.hasher.words(data, offsets)
        if not len(h):
            return {}
        block, first, first_block = _blocks(rows, len(offsets) - 1)
        term = items.term_numbers(h)
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first_block))
        out: dict[tuple[int, int], tuple[int, bool]] = {}
        for b, item in self.retrieved(term, rows, block, first, first_block):
            row, w = int(row_of[b]), items.words[item]
            if out.get((row, item), (0, False))[0] == len(w):
                continue
            common, region = self._common(item, term, first, first_block, row, b, b + 1)
            if common < rules.loose * len(w) or common <= out.get((row, item), (0, False))[0]:
                continue
            paraphrase = common < rules.exact * len(w)
            if paraphrase:
                answer = items.answers[item]
                if np.isin(answer, region).sum() < rules.answer_share * len(answer):
                    continue
                if common < rules.paraphrase * len(w) and self.sense(item, region) < rules.same_sense:
                    continue
            out[row, item] = (common, paraphrase)
        return out


def _pairs_udf(items: Items, space: LatentSpace, rules: Rules):
    def run(batches):
        find = Finder(items, space, rules)
        for batch in batches:
            for first, data, offsets in text_chunks(pc.utf8_lower(batch.column(1))):
                found = sorted(find.leaks(data, offsets).items())
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([first + r for (r, _), _ in found])),
                         pa.array([items.ids[i] for (_, i), _ in found], pa.int64()),
                         pa.array([len(items.words[i]) for (_, i), _ in found], pa.int64()),
                         pa.array([c for _, (c, _) in found], pa.int64()),
                         pa.array([p for _, (_, p) in found], pa.bool_())],
                        names=["doc_id", "item_id", "item_words", "common_words", "paraphrase"])
    return run


def _clean_udf(items: Items, space: LatentSpace, rules: Rules, at: int):
    def run(batches):
        find = Finder(items, space, rules)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, data, offsets in text_chunks(pc.utf8_lower(batch.column(at))):
                keep[[first + r for r, _ in find.leaks(data, offsets)]] = False
            yield batch.filter(pa.array(keep))
    return run


def _item_blocks(benchmark: DataFrame, item_block: int):
    """The benchmark's items, ``item_block`` at a time."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer).orderBy("item_id")
    block = []
    for r in rows.toLocalIterator():
        block.append(tuple(r))
        if len(block) == item_block:
            yield load_items(block)
            block = []
    if block:
        yield load_items(block)


PAIRS = "doc_id long, item_id long, item_words long, common_words long, paraphrase boolean"


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None, item_block: int = 500) -> DataFrame:
    """One row for each document and benchmark item that it holds: ``doc_id``,
    ``item_id``, ``item_words``, ``common_words`` (longest common subsequence),
    ``paraphrase`` (accepted by its answer). ``docs`` has ``doc_id``, ``text``;
    ``benchmark`` has ``item_id``, ``text`` and may have ``answer``.

    Null and empty texts hold nothing; items without an id or words are left
    out; repeated rows are reported each; an empty table on either side gives
    an empty result. Other columns are ignored."""
    rules, out = rules or Rules(), None
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for items in _item_blocks(benchmark, item_block):
        if items.ids:
            part = texts.mapInArrow(_pairs_udf(items, fit_latent(texts.select("text"), items), rules), PAIRS)
            out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], PAIRS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None, item_block: int = 500) -> DataFrame:
    """``docs`` less the rows that :func:`find_leaks` would report, all columns
    kept and no row moved."""
    rules, out = rules or Rules(), small_batches(docs)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    for items in _item_blocks(benchmark, item_block):
        if items.ids:
            out = out.mapInArrow(_clean_udf(items, fit_latent(texts, items), rules, docs.columns.index("text")), docs.schema)
    return out
