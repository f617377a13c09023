"""Fill-in-middle samples cut at token boundaries through a learned rank index.

A text's boundaries (0 and the end of each token, in code points) are a
monotone function of the token's rank, close to a line. :class:`RankIndex`
fits it by straight pieces: a piece starts as the whole text, a line through
its end points, and is halved as long as a boundary lies more than ``BOUND``
code points off its line. What the lines miss is kept as one byte for each
boundary, so a boundary is found by predicting it from its piece and adding its
residual: exact, from some bytes a token. All texts of a batch are fitted
together in numpy.

A token is the white space before a word (0x20, 0x09-0x0D) and the word, or the
white space at a text's end. Cuts and form of a document are drawn from the
sha256 of ``<seed>:<doc_id>``, so a rerun, a lost executor or another
partitioning gives the same samples.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.words import text_chunks

BOUND = 127  # residuals fit a signed byte
# The marks of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def token_boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, starts)`` of texts given as UTF-8 bytes and their offsets:
    text ``d`` has the boundaries ``values[starts[d]:starts[d + 1]]``, in code
    points, 0 first."""
    n_texts = len(offsets) - 1
    first = np.zeros(len(data) + 1, np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=first[1:])
    solid = ~_SPACE[data]
    last = np.zeros(len(data) + 1, bool)
    last[offsets[1:]] = True
    after = np.append(solid[1:], False)
    ends = np.flatnonzero(solid & (~after | last[1:])) + 1
    text_of_end = np.searchsorted(offsets, ends - 1, "right") - 1
    # white space at the end of a text is a token of its own
    filled = np.flatnonzero(np.diff(offsets) > 0)
    tail = np.zeros(n_texts, np.int64)
    tail[filled] = ~solid[offsets[filled + 1] - 1]
    words = np.bincount(text_of_end, minlength=n_texts)
    starts = np.append(0, np.cumsum(1 + words + tail))
    values = np.empty(starts[-1], np.int64)
    values[starts[:-1]] = offsets[:-1]
    before = np.append(0, np.cumsum(words))[:-1]
    values[starts[text_of_end] + 1 + np.arange(len(ends)) - before[text_of_end]] = ends
    tails = np.flatnonzero(tail)
    values[starts[tails + 1] - 1] = offsets[tails + 1]
    values = first[values]
    return values - np.repeat(first[offsets[:-1]], np.diff(starts)), starts


class RankIndex:
    """Piecewise-linear index of the boundaries of several texts."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, bound: int = BOUND):
        if not 0 <= bound <= BOUND:
            raise ValueError(f"bound must lie in 0 .. {BOUND}")
        self.starts = starts
        self.residuals = np.zeros(len(values), np.int8)
        lo, hi = starts[:-1], starts[1:] - 1
        done = []
        while len(lo):
            size = hi - lo + 1
            at = np.repeat(lo - np.append(0, np.cumsum(size))[:-1], size) + np.arange(size.sum())
            miss = values[at] - self._line(at, *(np.repeat(x, size) for x in (lo, values[lo], hi, values[hi])))
            worst = np.maximum.reduceat(np.abs(miss), np.append(0, np.cumsum(size))[:-1])
            fits = worst <= bound
            kept = np.repeat(fits, size)
            self.residuals[at[kept]] = miss[kept]
            done.append(np.column_stack([lo[fits], values[lo[fits]], hi[fits], values[hi[fits]]]))
            lo, hi = lo[~fits], hi[~fits]
            mid = (lo + hi) // 2
            lo, hi = np.concatenate([lo, mid + 1]), np.concatenate([mid, hi])
        self.pieces = np.concatenate(done) if done else np.zeros((0, 4), np.int64)
        self.pieces = self.pieces[np.argsort(self.pieces[:, 0], kind="stable")]

    @staticmethod
    def _line(at, lo, value_lo, hi, value_hi):
        return value_lo + (at - lo) * (value_hi - value_lo) // np.maximum(hi - lo, 1)

    def counts(self) -> np.ndarray:
        """Number of tokens of each text."""
        return np.diff(self.starts) - 1

    def boundary(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Where the first ``rank`` tokens of ``text`` end: predicted by the
        piece that holds the rank, corrected by the residual."""
        at = self.starts[text] + rank
        piece = self.pieces[np.searchsorted(self.pieces[:, 0], at, "right") - 1]
        return self._line(at, *piece.T) + self.residuals[at]

    def of_text(self, text: int) -> dict:
        """One text's pieces (rank and value at both ends) and residuals."""
        lo, hi = self.starts[text], self.starts[text + 1]
        own = self.pieces[np.searchsorted(self.pieces[:, 0], lo):np.searchsorted(self.pieces[:, 0], hi)].copy()
        own[:, [0, 2]] -= lo
        return {"pieces": [dict(zip(("rank", "value", "last_rank", "last_value"), map(int, p))) for p in own],
                "residuals": self.residuals[lo:hi].tobytes()}


def draws(doc_id: int | None, seed: int = 42) -> list[int]:
    """Four 32-bit numbers of a document (a null id counts as no digits)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[k:k + 8], 16) for k in range(0, 32, 8)]


def form_of(text: str, h3: int, h4: int, fim_percent: int = 50, spm_percent: int = 80) -> str:
    """``plain`` for an empty text, one that holds a mark, or by the draw; else
    ``spm`` or ``psm``."""
    if not text or h3 % 100 >= fim_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain"
    return "spm" if h4 % 100 < spm_percent else "psm"


def transform(text: str, form: str, a: int, b: int) -> str:
    """The sample of a text whose middle is ``text[a:b]``."""
    if form == "plain":
        return text
    if form == "psm":
        return f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
    return f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"


def restore(output: str, form: str) -> str:
    """The text that :func:`transform` was given. No part holds a mark and no
    mark overlaps itself, so the first place of a mark is its own."""
    if form == "plain":
        return output
    mark = SUFFIX if form == "psm" else PREFIX
    first, _, rest = output[len(mark):].partition(mark)
    second, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


# ---- Spark jobs

_INDEX = ("doc_id long, n long, pieces array<struct<rank: long, value: long, last_rank: long, last_value: long>>, "
          "residuals binary")
_SAMPLE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
_DIGEST = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
           "restored_sha256 string")
_TYPES = {"long": pa.int64(), "string": pa.string()}


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def rank_index(docs: DataFrame, bound: int = BOUND) -> DataFrame:
    """The index of each row's text: ``doc_id``, ``n`` tokens, ``pieces`` and
    ``residuals`` (one signed byte a boundary). A null text is empty: no token,
    one boundary."""
    def run(batches):
        piece = pa.struct([(k, pa.int64()) for k in ("rank", "value", "last_rank", "last_value")])
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                index = RankIndex(*token_boundaries(data, offsets), bound)
                rows = [index.of_text(d) for d in range(len(offsets) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(rows)), pa.array(index.counts(), pa.int64()),
                     pa.array([r["pieces"] for r in rows], pa.list_(piece)),
                     pa.array([r["residuals"] for r in rows], pa.binary())],
                    names=["doc_id", "n", "pieces", "residuals"])
    return _keyed(docs).mapInArrow(run, _INDEX)


def _samples(seed: int, fim_percent: int, spm_percent: int, bound: int, digest: bool):
    schema = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in (_DIGEST if digest else _SAMPLE).split(", "))])
    sha = (lambda s: hashlib.sha256(s.encode()).hexdigest()) if digest else (lambda s: s)

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                k = len(offsets) - 1
                ids = batch.column(0).slice(first, k).to_pylist()
                index = RankIndex(*token_boundaries(data, offsets), bound)
                h = np.array([draws(i, seed) for i in ids], np.int64)
                n = index.counts()
                cuts = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
                a, b = (index.boundary(np.arange(k), cuts[:, c]) for c in (0, 1))
                rows = []
                for d, doc_id in enumerate(ids):
                    text = data[offsets[d]:offsets[d + 1]].tobytes().decode()
                    lo, hi = int(a[d]), int(b[d])
                    form = form_of(text, int(h[d, 2]), int(h[d, 3]), fim_percent, spm_percent)
                    out = transform(text, form, lo, hi)
                    plain = form == "plain"
                    rows.append((doc_id, int(n[d]), form, None if plain else lo, None if plain else hi - lo,
                                 sha(out), sha(restore(out, form))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def fill_in_middle(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
                   bound: int = BOUND) -> DataFrame:
    """One sample for each row of ``docs`` (``doc_id``, ``text``): ``doc_id``,
    ``n`` tokens, ``form`` (plain, psm, spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain), ``output`` and the text ``restored`` from
    it. The rows stay where they are: no shuffle.

    A null text is empty and plain. Equal ids draw equal numbers, so repeated
    rows give equal samples; a null id draws from the seed alone. A text that
    holds a mark stays plain. Other columns aren't read."""
    return _keyed(docs).mapInArrow(_samples(seed, fim_percent, spm_percent, bound, False), _SAMPLE)


def fill_in_middle_digests(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
                           bound: int = BOUND) -> DataFrame:
    """:func:`fill_in_middle` with the sha256 of ``output`` and ``restored`` in
    their place, taken where the samples are made."""
    return _keyed(docs).mapInArrow(_samples(seed, fim_percent, spm_percent, bound, True), _DIGEST)


def fill_in_middle_sql(table: str = "documents", seed: int = 42) -> str:
    """DuckDB SQL of :func:`fill_in_middle_digests` with its default shares."""
    token = r"[ \t\n\x0B\f\r]*[^ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+"
    draw = lambda k: f"cast('0x' || substr(h, {8 * k + 1}, 8) as bigint)"
    marked = " or ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
with d as (
  select doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{token}') as tok,
         sha256('{seed}:' || coalesce(cast(doc_id as varchar), '')) as h
  from {table}),
c as (
  select doc_id, t, tok, len(tok) as n, {draw(0)} % (len(tok) + 1) as x, {draw(1)} % (len(tok) + 1) as y,
         case when t = '' or {marked} or {draw(2)} % 100 >= 50 then 'plain'
              when {draw(3)} % 100 < 80 then 'spm' else 'psm' end as form
  from d),
p as (
  select doc_id, t, n, form,
         length(array_to_string(tok[1:least(x, y)], '')) as a,
         length(array_to_string(tok[1:greatest(x, y)], '')) as b
  from c),
s as (
  select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from p)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(a as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(b - a as bigint) end as middle_chars,
       sha256(case form when 'plain' then t
                        when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end) as output_sha256,
       sha256(case form when 'plain' then t else prefix || middle || suffix end) as restored_sha256
from s"""
