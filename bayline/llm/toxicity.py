"""Toxicity scores after noisy-channel restoration of obfuscated words.

1. A character trigram model counts the letters of all documents (``a``-``z``
   folded, a word edge, one class for other letters); the counts are summed
   per task before they are gathered.
2. Obfuscated spots are runs that mix letters with look-alike signs
   (``1d10t``), letters repeated three or more times (``stuuupid``) and single
   letters with one sign between them (``i d i o t``). Each becomes a lattice
   of readings; Viterbi picks the most likely one under the trigram model and
   the channel's costs, and the text is rewritten with it.
3. A restored text's features are its words and their prefixes of 4, 5 and 6
   bytes (present or not). A lexicon is grown by greedy cover of the toxic
   training texts from features nearly absent in clean ones, near copies counting
   once; a logistic regression weighs the lexicon.

The classifier is fitted on a bounded sample of labelled rows
(``max_train``); the model of letters and the scores cover all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.staging import small_batches, staged
from bayline.llm.words import WordHasher, mix64, text_chunks

# Signs read as letters.
LOOK_ALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "il", "|": "il", "+": "t"}
# Channel costs, in nats: a sign read as a letter, a sign dropped (``!``, ``|``
# and ``+`` also end words), a doubled letter read as one, and the gain that
# makes two letters as likely as one where three or more stand.
READ_COST, DROP_COST, END_COST, HALVE_COST, DOUBLE_GAIN = 0.7, 12.0, 3.0, 3.0, 2.0
PREFIXES = (4, 5, 6)
N_CLASS = 28  # 0 word edge, 1-26 letters, 27 letters beyond ASCII


def _classes() -> np.ndarray:
    c = np.zeros(256, np.int64)
    c[65:91] = c[97:123] = np.arange(1, 27)
    c[128:] = 27
    return c


def _trigram_udf(batches):
    cls, total = _classes(), np.zeros(N_CLASS ** 3, np.int64)
    for batch in batches:
        for _, data, offsets in text_chunks(batch.column(0)):
            # two edges between texts, so that no trigram spans them
            c = np.insert(cls[data], np.repeat(offsets, 2), 0)
            if len(c) > 2:
                total += np.bincount((c[:-2] * N_CLASS + c[1:-1]) * N_CLASS + c[2:], minlength=N_CLASS ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["tri", "n"])


def letter_model(texts: DataFrame) -> np.ndarray:
    """Log probability of a letter class after two others, add-half smoothed;
    ``texts`` has one column ``text``. Empty tables give the uniform model."""
    counts = texts.mapInArrow(_trigram_udf, "tri int, n long").groupBy("tri").agg(F.sum("n").alias("n"))
    n = np.full(N_CLASS ** 3, 0.5)
    for tri, c in counts.collect():  # at most 28 ** 3 rows
        n[tri] += c
    n = n.reshape(N_CLASS, N_CLASS, N_CLASS)
    n[0, 0] = n[27, 0] + n[:, 0].sum(0)  # a word's first letter: after any edge
    return np.log(n / n.sum(2, keepdims=True))


class Restorer:
    """Most likely reading of obfuscated spots; readings are kept per task."""

    def __init__(self, log_p: np.ndarray, keep: int = 100_000):
        self.log_p, self.keep, self.known = log_p, keep, {}
        self.leet = np.zeros(256, bool)
        self.leet[[ord(c) for c in LOOK_ALIKES]] = True
        self.letter = np.zeros(256, bool)
        self.letter[65:91] = self.letter[97:123] = True
        self.part = self.leet | self.letter
        self.gap = np.zeros(256, bool)
        self.gap[[ord(c) for c in " .-_*"]] = True

    def read(self, spot: bytes) -> bytes:
        """Viterbi over the lattice of readings; states are the last two
        letters, ties go to the reading met first."""
        got = self.known.get(spot)
        if got is None:
            got = self._viterbi(spot.decode("latin-1").lower())
            if len(self.known) < self.keep:
                self.known[spot] = got
        return got

    def _viterbi(self, s: str) -> bytes:
        lp = self.log_p
        best, back = {(0, 0): 0.0}, []
        i = 0
        while i < len(s):
            j = i
            while j < len(s) and s[j] == s[i]:
                j += 1
            c, n = s[i], j - i
            copies = (n,) if n < 3 else (1, 2)
            if c in LOOK_ALIKES:
                drop = END_COST if c in "!|+" and (j == len(s) or i == 0) else DROP_COST
                arcs = [(x * m, READ_COST * n - (DOUBLE_GAIN if m == 2 < n else 0))
                        for x in LOOK_ALIKES[c] for m in copies] + [("", drop)]
            elif n >= 2:
                arcs = [(c * 2, 0.0 if n == 2 else -DOUBLE_GAIN), (c, HALVE_COST if n == 2 else 0.0)]
            else:
                arcs = [(c, 0.0)]
            nxt, ptr = {}, {}
            for (p, q), score in best.items():
                for out, cost in arcs:
                    a, b, v = p, q, score - cost
                    for x in out:
                        k = ord(x) - 96
                        v += lp[a, b, k]
                        a, b = b, k
                    if v > nxt.get((a, b), -math.inf):
                        nxt[a, b], ptr[a, b] = v, ((p, q), out)
            best = nxt
            back.append(ptr)
            i = j
        state = max(best, key=lambda k: best[k] + lp[k[0], k[1], 0])
        out = []
        for ptr in reversed(back):
            state, piece = ptr[state]
            out.append(piece)
        return "".join(reversed(out)).encode()

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A chunk's texts with every obfuscated spot replaced."""
        n = len(data)
        part = self.part[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        prev, nxt = np.zeros(n, bool), np.zeros(n, bool)
        prev[1:], nxt[:-1] = part[:-1], part[1:]
        start, end = np.flatnonzero(part & (~prev | cut[:-1])), np.flatnonzero(part & (~nxt | cut[1:])) + 1
        if not len(start):
            return data, offsets
        def inside(flag):
            c = np.concatenate([[0], np.cumsum(flag)])
            return c[end] - c[start]
        letters, signs = inside(self.letter[data]), inside(self.leet[data])
        low = data | np.uint8(32)
        triple = np.zeros(n, bool)
        triple[2:] = self.letter[data[2:]] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
        odd = (letters > 0) & ((signs > 0) | (inside(triple) > 0))
        # single characters with one gap sign between them, four or more
        single = end - start == 1
        chained = np.zeros(len(start), bool)
        if len(start) > 1:
            chained[1:] = (single[1:] & single[:-1] & (start[1:] - end[:-1] == 1)
                           & self.gap[data[np.minimum(end[:-1], n - 1)]] & ~cut[start[1:]])
        chain_no = np.cumsum(~chained)
        size = np.bincount(chain_no)[chain_no]
        spaced = chained | np.append(chained[1:], False)
        has_letters = np.bincount(chain_no, weights=letters)[chain_no]
        spaced &= (size >= 4) & (has_letters >= 2)
        spots = [(int(start[i]), int(end[i]), None) for i in np.flatnonzero(odd & ~spaced)]
        if spaced.any():
            raw_runs = np.flatnonzero(spaced)
            for run in np.split(raw_runs, np.flatnonzero(np.diff(chain_no[raw_runs])) + 1):
                spots.append((int(start[run[0]]), int(end[run[-1]]), start[run]))
            spots.sort(key=lambda x: x[0])
        if not spots:
            return data, offsets
        raw, out, shift, at = data.tobytes(), [], [], 0
        for s, e, singles in spots:
            new = self.read(raw[s:e] if singles is None else bytes(raw[i] for i in singles))
            out += [raw[at:s], new]
            shift.append((e, len(new) - (e - s)))
            at = e
        out.append(raw[at:])
        moved = np.concatenate([[0], np.cumsum([d for _, d in shift])])
        new_off = offsets + moved[np.searchsorted([e for e, _ in shift], offsets, "right")]
        return np.frombuffer(b"".join(out), np.uint8), new_off


class _Features:
    """Hashed words and word prefixes of restored texts."""

    def __init__(self, log_p: np.ndarray):
        self.restore = Restorer(log_p)
        self.hasher = WordHasher(lower=True)
        alnum = np.zeros(256, bool)
        alnum[48:58] = alnum[65:91] = alnum[97:123] = alnum[128:] = True
        self.hasher.space = ~alnum

    def rows(self, data, offsets) -> list[tuple[np.ndarray, np.ndarray]]:
        """``(text's row, feature)`` arrays, one for each kind of feature."""
        data, offsets = self.restore.chunk(data, offsets)
        h, rows, starts, ends = self.hasher.words(data, offsets)
        out = [(rows, h)]
        up, down = self.hasher.bytes_pw.get(len(data)) if len(data) else (None, None)
        if len(h):
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hasher.values[data] * up, dtype=np.uint64)])
            for n in PREFIXES:
                at = np.flatnonzero(ends - starts > n)
                s = starts[at]
                out.append((rows[at], mix64((c[s + n] - c[s]) * down[s] + np.uint64(n))))
        return out


def _training_udf(log_p, wanted: np.ndarray | None):
    """Features of each text, those in ``wanted`` only if given."""
    def run(batches):
        make = _Features(log_p)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                row, feat = (np.concatenate(x) for x in zip(*make.rows(data, offsets)))
                if wanted is not None:
                    at = np.searchsorted(wanted, feat)
                    ok = wanted[np.minimum(at, len(wanted) - 1)] == feat
                    row, feat = row[ok], feat[ok]
                n = len(offsets) - 1
                order = np.argsort(row, kind="stable")
                parts = np.split(feat[order], np.cumsum(np.bincount(row, minlength=n))[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n),
                     pa.array([np.unique(p).view(np.int64) for p in parts], pa.list_(pa.int64()))],
                    names=["toxic", "features"])
    return run


@dataclass
class ToxicityModel:
    log_p: np.ndarray
    lexicon: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float


def _cover(lists: list[np.ndarray], clean: dict[int, int], min_gain: int, most: int, times: int = 3) -> list[int]:
    """Features that cover each toxic text ``times`` times, largest gain first.
    Near copies, which share their two smallest features, count as one text."""
    lists = list({tuple(np.sort(f)[:2].tolist()): f for f in lists if len(f)}.values())
    where: dict[int, list[int]] = {}
    for i, fs in enumerate(lists):
        for f in fs:
            where.setdefault(int(f), []).append(i)
    need = np.full(len(lists), times, np.int64)
    # nearly absent in clean texts: at most one clean text to fifty toxic ones
    pool = {f: np.array(d) for f, d in where.items() if len(d) >= min_gain and 50 * clean.get(f, 0) <= len(d)}
    chosen = []
    while pool and len(chosen) < most:
        gain = {f: int((need[d] > 0).sum()) for f, d in pool.items()}
        f = max(gain, key=lambda x: (gain[x], len(pool[x]), -x))
        if gain[f] < min_gain:
            break
        chosen.append(f)
        need[pool.pop(f)] -= 1
        pool = {x: d for x, d in pool.items() if gain[x] >= min_gain}
    return chosen


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = 15_000, min_gain: int = 3,
                 max_lexicon: int = 512) -> ToxicityModel:
    """Letter model from all ``docs``; lexicon and weights from labelled rows
    whose crc32(``doc_id`` as text) mod 3 is not 1, at most about
    ``max_train`` of them (a fixed hash of ``doc_id`` decides). A word needs
    ``min_gain`` different toxic texts among them, however many there are. Labels other
    than 0 and 1 are left out; without toxic rows the lexicon is empty and
    every score is the smoothed share of toxic rows."""
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    log_p = letter_model(texts.select("text"))
    train = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = train.count()
    if n > max_train:
        train = train.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(1_000_000 * max_train / n))
    # about max_train pairs of numbers are broadcast: no text is shuffled
    rows = staged(texts.join(F.broadcast(train), "doc_id").select("toxic", "text"), "toxic-train")
    kind = "toxic int, features array<long>"
    # at most max_train rows of whole-text features of toxic rows reach the driver
    toxic = [np.array(r.features, np.int64) for r in
             rows.where("toxic = 1").mapInArrow(_training_udf(log_p, None), kind).toLocalIterator()]
    seen, times_seen = np.unique(np.concatenate([np.zeros(0, np.int64), *toxic]), return_counts=True)
    frequent = np.sort(seen[times_seen >= min_gain].view(np.uint64))
    empty = ToxicityModel(log_p, np.zeros(0, np.uint64), np.zeros(0), 0.0)
    n_clean = rows.where("toxic = 0").count()
    if not len(frequent):
        empty.bias = math.log((len(toxic) + 0.5) / (n_clean + 0.5))
        return empty
    clean_rows = (rows.where("toxic = 0").mapInArrow(_training_udf(log_p, frequent), kind)
                  .select(F.explode("features").alias("f")).groupBy("f").count())
    clean = {f: c for f, c in clean_rows.toLocalIterator()}
    lists = [fs[np.isin(fs, seen[times_seen >= min_gain])] for fs in toxic]
    lexicon = np.sort(np.array(_cover(lists, clean, min_gain, max_lexicon), np.int64).view(np.uint64))
    if not len(lexicon):
        empty.bias = math.log((len(toxic) + 0.5) / (n_clean + 0.5))
        return empty
    x, y, times = [], [], []
    patterns = (rows.mapInArrow(_training_udf(log_p, lexicon), kind)
                .groupBy("toxic", "features").agg(F.count("*").alias("n")))
    for r in patterns.toLocalIterator():
        v = np.zeros(len(lexicon))
        v[np.searchsorted(lexicon, np.array(r.features, np.int64).view(np.uint64))] = 1
        x.append(v)
        y.append(r.toxic)
        times.append(r.n)
    weights, bias = _logistic(np.array(x), np.array(y, float), np.array(times, float))
    return ToxicityModel(log_p, lexicon, weights, bias)


def _logistic(x, y, times, l2: float = 0.05, steps: int = 30) -> tuple[np.ndarray, float]:
    """Newton steps for an L2 logistic regression on weighted rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.full(len(w), l2)
    reg[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (times * (p - y)) + reg * w
        hess = (x1 * (times * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x1 + np.diag(reg)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _score_udf(model: ToxicityModel):
    def run(batches):
        make = _Features(model.log_p)
        lexicon, k = model.lexicon, len(model.lexicon)
        maybe = np.zeros(1 << 16, bool)
        maybe[lexicon >> np.uint64(48)] = True
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                n = len(offsets) - 1
                z = np.full(n, model.bias)
                if k:
                    hits = []
                    for row, feat in make.rows(data, offsets):
                        at = np.flatnonzero(maybe[feat >> np.uint64(48)])
                        j = np.minimum(np.searchsorted(lexicon, feat[at]), k - 1)
                        ok = lexicon[j] == feat[at]
                        hits.append(row[at[ok]] * k + j[ok])
                    hit = np.unique(np.concatenate(hits))
                    z += np.bincount(hit // k, weights=model.weights[hit % k], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, n) for c in batch.columns[:1]), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                    names=["doc_id", "score"])
    return run


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) per row of ``docs``; a null text scores
    as an empty one, a null ``doc_id`` stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _score_udf(model), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out`` (its label was not to be
    learnt from), ``score``, ``predicted`` (1 from ``threshold`` on). Only
    ``doc_id`` and ``text`` are read; an empty table gives an empty result."""
    scored = score_texts(docs, fit_toxicity(docs, labels))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _filter_udf(model: ToxicityModel, threshold: float, at: int):
    score = _score_udf(model)

    def run(batches):
        for batch in batches:
            pair = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(batch.num_rows)), batch.column(at)], names=["row", "text"])
            kept = [np.asarray(b.column(1)) < threshold for b in score(iter([pair]))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))
    return run


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """``docs`` less the rows scored ``threshold`` or more, all columns kept
    and no row moved."""
    return small_batches(docs).mapInArrow(_filter_udf(model, threshold, docs.columns.index("text")), docs.schema)
