"""Personal data: base patterns, and a conditional random field for variants.

Base spans come from four patterns (email, ip, card, phone). A linear-chain
conditional random field over word-shape features adds spans that the patterns
miss, such as a phone number without its plus sign or an address written with
``[at]``. It is trained on the driver from a small labelled table (token
sequences whose spans are known, at most ``max_sequences``, and the rule-made
ones of :mod:`bayline.llm.pii_variants`) and decoded by Viterbi over numpy
batches of sequences in the tasks.

The sequences cover every place of a text that may hold personal data: the
words within ``CONTEXT`` bytes of a digit, an at sign or plus sign, a bracketed
``at`` or the word ``dot``, whole words at either end. A sequence longer than
``MAX_TOKENS`` is decoded in pieces that overlap; a span is taken from the piece
where it begins at least ``BEFORE`` tokens from a cut and has ``AFTER`` more to
the next one, and if it still reaches that one, from a longer piece. A decoded
span is added when it is plausible for its kind, scores above reading its tokens
as plain text by ``margin`` and touches no base span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.pii_variants import sentences
from bayline.llm.staging import small_batches, staged
from bayline.llm.words import text_chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_LABELS = len(LABELS)
CONTEXT, MAX_TOKENS, BEFORE, AFTER = 40, 256, 16, 80
TRAIN_TOKENS = 64  # longer training sequences are taken in pieces

# Each pattern starts only where an unanchored search would find its leftmost
# match: a run's start. The plain patterns are in the query's contract.
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]")
_BRACKET = re.compile(rb"[\[(](?:at|dot)[\])]", re.I)
_LETTER = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find(b"@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while m and start > done and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            yield start, m.end()
            done = m.end()
        at = text.find(b"@", max(at + 1, done))


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` byte spans, by kind as listed, then start."""
    out = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m[0].split(b".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = m[0].replace(b" ", b"").replace(b"-", b"")
        if 16 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- sequences and features

def _marks(text: bytes) -> list[int]:
    """Places of bracketed ``at`` and ``dot``, and of the word ``dot``."""
    out = [m.start() for m in _BRACKET.finditer(text)]
    low = text.lower()
    at = low.find(b"dot")
    while at >= 0:
        if (at == 0 or low[at - 1] not in _LETTER) and (at + 3 == len(low) or low[at + 3] not in _LETTER):
            out.append(at)
        at = low.find(b"dot", at + 3)
    return out


def _windows(text: bytes, triggers: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges around the triggers, from white space to white space; no
    two meet."""
    at = np.unique(np.concatenate([triggers, _marks(text)]).astype(np.int64))
    if not len(at):
        return
    edge = np.concatenate([[-1], np.flatnonzero(_SPACE[np.frombuffer(text, np.uint8)]), [len(text)]])
    lo = edge[np.searchsorted(edge, np.maximum(at - CONTEXT, 0)) - 1] + 1
    hi = edge[np.searchsorted(edge, np.minimum(at + CONTEXT, len(text)))]
    new = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    starts, ends = lo[new], np.append(hi[np.flatnonzero(new)[1:] - 1], hi[-1])
    for s, e in zip(starts.tolist(), ends.tolist()):
        yield s, e


def tokens(text: bytes, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def _shape(token: bytes, spaced: bool) -> int:
    """Word shape: kind of characters, length class, space before."""
    c = token[0]
    if 48 <= c <= 57:
        s = 1 + min(len(token), 20)
    elif token.isalpha() or c >= 128:
        case = 0 if token.islower() else 1 if token.isupper() else 2
        s = 24 + 4 * case + min(len(token), 16) // 5
        if token.lower() in (b"at", b"dot"):
            s = 37 + (token.lower() == b"dot")
    else:
        s = 40 + (_SIGNS.find(token) + 1)
    return 2 * s + spaced


_SIGNS = b"@.+-()[],:;/%_#=&?!*\"'"
AT_BEFORE_DOT = 40 + len(_SIGNS) + 1  # the word "at" and, near after it, "dot"
N_SHAPES = 2 * (AT_BEFORE_DOT + 2)
NEAR = 6
OFFSETS = (-2, -1, 0, 1, 2)


def shapes(text: bytes, spans: list[tuple[int, int]]) -> np.ndarray:
    out = np.array([_shape(text[s:e], i == 0 or spans[i - 1][1] < s) for i, (s, e) in enumerate(spans)], np.int32)
    at, dot = np.flatnonzero(out // 2 == 37), np.flatnonzero(out // 2 == 38)
    if len(at) and len(dot):
        # either word alone is text, both close together are an address
        after, before = np.searchsorted(dot, at), np.searchsorted(at, dot) - 1
        paired = (after < len(dot)) & (dot[np.minimum(after, len(dot) - 1)] - at <= NEAR)
        out[at[paired]] += 2 * (AT_BEFORE_DOT - 37)
        paired = (before >= 0) & (dot - at[np.maximum(before, 0)] <= NEAR)
        out[dot[paired]] += 2 * (AT_BEFORE_DOT + 1 - 38)
    return out


def _padded(seqs: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(seqs), max(map(len, seqs))), fill, np.int32)
    for i, s in enumerate(seqs):
        out[i, :len(s)] = s
    return out


class Crf:
    """Weights: a label score for the shape at each of five offsets, and label
    transitions; ``I`` follows only its own kind."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = np.zeros((len(OFFSETS), N_SHAPES, N_LABELS)) if emit is None else emit
        self.move = np.zeros((N_LABELS, N_LABELS)) if move is None else move
        allowed = np.ones((N_LABELS, N_LABELS), bool)
        for j in range(2, N_LABELS, 2):
            allowed[:, j] = False
            allowed[[j - 1, j], j] = True
        self.banned = np.where(allowed, 0.0, -1e9)
        self.first = np.where([i and i % 2 == 0 for i in range(N_LABELS)], -1e9, 0.0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Label scores (sequences, tokens, labels) of padded shapes; shape 0
        stands beyond a sequence's ends."""
        wide = np.pad(x, ((0, 0), (2, 2)))
        n = x.shape[1]
        return sum(self.emit[k][wide[:, 2 + o:2 + o + n]] for k, o in enumerate(OFFSETS))

    def viterbi(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels of each sequence, and the label scores."""
        s = self.scores(x)
        n, t, _ = s.shape
        move = self.move + self.banned
        best, back = s[:, 0] + self.first, np.zeros((n, t, N_LABELS), np.int8)
        for i in range(1, t):
            step = best[:, :, None] + move
            back[:, i] = step.argmax(1)
            live = (i < lengths)[:, None]
            best = np.where(live, step.max(1) + s[:, i], best)
        labels = np.zeros((n, t), np.int8)
        cur, rows = best.argmax(1), np.arange(n)
        for i in range(t - 1, -1, -1):
            live = i < lengths
            labels[live, i] = cur[live]
            cur = np.where(live & (i > 0), back[rows, i, cur], cur)
        return labels, s

    def fit(self, seqs: list[np.ndarray], labels: list[np.ndarray], steps: int = 120, rate: float = 0.15,
            l2: float = 1e-4) -> Crf:
        """Maximum likelihood by Adam on the whole (small) table, longest
        sequences first: a step over tokens meets only those that go on."""
        order = sorted(range(len(seqs)), key=lambda k: -len(seqs[k]))
        x, y = _padded([seqs[k] for k in order], 0), _padded([labels[k] for k in order], 0)
        lengths = np.array([len(seqs[k]) for k in order])
        n, t = x.shape
        live = np.arange(t) < lengths[:, None]
        going = live.sum(0)
        wide = np.pad(x, ((0, 0), (2, 2)))
        around = [wide[:, 2 + o:2 + o + t][live] for o in OFFSETS]
        state = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.emit, self.move)]
        gold_move = np.zeros((N_LABELS, N_LABELS))
        both = live[:, 1:]
        np.add.at(gold_move, (y[:, :-1][both], y[:, 1:][both]), 1)
        gold = np.eye(N_LABELS)[y[live]]
        e, alpha, beta, scale = (np.ones((n, t, N_LABELS)) for _ in range(4))
        for step in range(1, steps + 1):
            s = sum(self.emit[k][around[k]] for k in range(len(OFFSETS)))
            em = np.exp(self.move + self.banned)
            e[live] = np.exp(s - s.max(1, keepdims=True))
            a = e[:, 0] * np.exp(self.first)
            for i, m in enumerate(going):
                a = (a[:m] @ em) * e[:m, i] if i else a
                scale[:m, i] = a.sum(1, keepdims=True)
                a = a / scale[:m, i]
                alpha[:m, i] = a
            b, pair = np.ones((n, N_LABELS)), np.zeros((N_LABELS, N_LABELS))
            beta[...] = 1.0
            for i in range(t - 1, 0, -1):
                m = going[i]
                eb = e[:m, i] * b[:m] / scale[:m, i]
                pair += em * (alpha[:m, i - 1].T @ eb)
                b[:m] = eb @ em.T
                beta[:m, i - 1] = b[:m]
            p = (alpha * beta)[live]
            diff = (gold - p / p.sum(1, keepdims=True)) / n
            grad = np.stack([np.stack([np.bincount(sh, diff[:, c], N_SHAPES) for c in range(N_LABELS)], 1) for sh in around])
            for w, g, m in ((self.emit, grad, state[0]), (self.move, (gold_move - pair) / n, state[1])):
                g = g - l2 * w
                m[0][...] = 0.9 * m[0] + 0.1 * g
                m[1][...] = 0.99 * m[1] + 0.01 * g * g
                w += rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
        return self


# ---- training table

def _label_tokens(spans: list[tuple[int, int]], found: list[tuple[str, int, int]]) -> np.ndarray:
    y = np.zeros(len(spans), np.int32)
    for kind, s, e in found:
        k = 1 + 2 * KINDS.index(kind)
        inside = [i for i, (a, b) in enumerate(spans) if a >= s and b <= e and y[i] == 0]
        for n, i in enumerate(inside):
            y[i] = k + (n > 0)
    return y


def _training(text: bytes, found: list[tuple[str, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The whole text as labelled pieces of about ``TRAIN_TOKENS``; no span is cut."""
    toks = tokens(text, 0, len(text))
    x, y = shapes(text, toks), _label_tokens(toks, found)
    k = 0
    while k < len(x):
        end = min(len(x), k + TRAIN_TOKENS)
        while end < len(x) and y[end] and y[end] % 2 == 0:
            end += 1
        yield x[k:end], y[k:end]
        k = end


def _variants(text: bytes, found: list[tuple[str, int, int]]) -> Iterator[tuple[bytes, list]]:
    """The sequence as it stands, and with its spans written another way."""
    yield text, found
    for change in (lambda k, x: x.replace(b"@", b" [at] ").replace(b".", b" [dot] ") if k == "email" else x,
                   lambda k, x: x.lstrip(b"+").replace(b" ", b"-") if k == "phone" else x):
        out, spans, at = [], [], 0
        for kind, s, e in sorted(found, key=lambda f: f[1]):
            if s < at:
                continue
            new = change(kind, text[s:e])
            out.append(text[at:s])
            begin = sum(map(len, out))
            out.append(new)
            spans.append((kind, begin, begin + len(new)))
            at = e
        out.append(text[at:])
        if (new_text := b"".join(out)) != text:
            yield new_text, spans


def _sequences_udf(batches):
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            raw = (text or "").encode("utf-8", "replace")
            triggers = np.flatnonzero(np.isin(np.frombuffer(raw, np.uint8), _TRIGGERS))
            found = base_spans(raw)
            for s, e in _windows(raw, triggers):
                mine = [(k, a - s, b - s) for k, a, b in found if a >= s and b <= e]
                for piece, spans in _variants(raw[s:e], mine):
                    out += [{"x": x.tolist(), "y": y.tolist()} for x, y in _training(piece, spans)]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("x", pa.list_(pa.int32())), ("y", pa.list_(pa.int32()))]))


_TRIGGERS = np.frombuffer(b"0123456789@+", np.uint8)


def labelled_sequences(docs: DataFrame, max_docs: int = 2_000) -> DataFrame:
    """A small labelled table ``x`` (word shapes), ``y`` (labels) from about
    ``max_docs`` documents that hold a digit or an at sign: their base spans,
    also rewritten as the patterns don't know them."""
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = texts.count()
    share = min(1.0, max_docs / max(1, n))
    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
    return some.select("text").mapInArrow(_sequences_udf, "x array<int>, y array<int>")


def variant_sequences(n: int = 2_500, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """The labelled table of :mod:`bayline.llm.pii_variants` as sequences; it is
    the same at every size of the corpus."""
    return [s for text, spans in sentences(n, seed) for s in _training(text.encode(), spans)]


def fit_pii(docs: DataFrame, max_sequences: int = 1_000) -> Crf:
    """A model from the variants and at most ``max_sequences`` sequences of
    ``docs``."""
    return train(labelled_sequences(docs), max_sequences, variant_sequences())


def train(labelled: DataFrame, max_sequences: int = 2_500, more: list | tuple = ()) -> Crf:
    """A model from a labelled table (see :func:`labelled_sequences`); the
    sequences that come first in hash order are used, equal ones once: up to
    four fifths with spans, and as many without as fit beside them, and with
    them the sequences ``more``. Without any of either, the model adds nothing."""
    rows, has = staged(labelled.where(F.size("x") > 1).distinct(), "pii-labelled"), F.exists("y", lambda v: v > 0)

    def first(some: DataFrame, most: int) -> list:
        taken = some.orderBy(F.xxhash64("x"), F.to_json("x"), F.to_json("y")).limit(most).collect()
        return [(np.array(r.x, np.int32), np.array(r.y, np.int32)) for r in taken]

    marked = first(rows.where(has), max_sequences * 4 // 5)
    model = Crf()
    if marked or more:
        both = marked + first(rows.where(~has), max_sequences - len(marked)) + list(more)
        model.fit([x for x, _ in both], [y for _, y in both])
    else:
        model.emit[2, :, 0] = 10.0
    return model


# ---- spans of whole texts

_AT = rb"(?:\s?@\s?|\s?[\[(]at[\])]\s?)"
_DOT_SIGN = rb"\s?[\[(](?:dot|\.)[\])]\s?|\s+dot\s+"
_ADDRESS = re.compile(
    rb"[A-Z0-9._%+-]+(?:" + _AT + rb"[A-Z0-9-]+(?:(?:\.|" + _DOT_SIGN + rb")[A-Z0-9-]+)+"
    # a bare "at" only where the dots are words too
    rb"|\s+at\s+[A-Z0-9-]+(?:(?:" + _DOT_SIGN + rb")[A-Z0-9-]+)+)", re.I)
_NUMBERS = re.compile(rb"[0-9]{1,3}(?:(?:\.|\s\.\s|" + _DOT_SIGN + rb")[0-9]{1,3}){3}", re.I)
_GROUPS = re.compile(rb"[0-9]{4}(?:(?:[ ._/-]{1,3}[0-9]{4}){3}(?:[ ._/-]{1,3}[0-9]{1,3})?"
                     rb"|[ ._/-]{1,3}[0-9]{6}[ ._/-]{1,3}[0-9]{4,5})|[0-9]{14,19}|[0-9](?:[ -]?[0-9]){15,18}")
_CALL = re.compile(
    rb"(?:\+|00|011[ .-])[ .-]?[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}|(?:(?:1|001)[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
    rb"|(?:(?:1|001)[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}|0[0-9]{2,4}[ /-][0-9]{5,8}")


def _plausible(kind: str, piece: bytes) -> bool:
    """Whether a decoded span has a form that its kind can have."""
    only = bytes(c for c in piece if 48 <= c <= 57)
    if kind == "email":
        return _ADDRESS.fullmatch(piece) is not None
    if kind == "ip":
        return _NUMBERS.fullmatch(piece) is not None and all(int(p) <= 255 for p in re.findall(rb"[0-9]+", piece))
    if kind == "card":
        known = 16 <= len(only) <= 19 or only[:2] in _SHORT_CARDS.get(len(only), ())
        return known and _luhn(only) and _GROUPS.fullmatch(piece) is not None
    return 8 <= len(only) <= 15 and _CALL.fullmatch(piece) is not None


# fixed values: first digits of card numbers of 14 and 15 digits
_SHORT_CARDS = {14: (b"30", b"36", b"38"), 15: (b"34", b"37")}


def _pieces(n: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last token of each piece of ``n`` tokens, and the tokens where
    the spans that it gives begin: each token in one piece."""
    k = own = 0
    while own < n:
        stop = min(n, k + MAX_TOKENS)
        end = n if stop == n else stop - AFTER
        yield k, stop, own, end
        k, own = end - BEFORE, end


class Finder:
    """Base and added spans of a chunk of texts."""

    def __init__(self, model: Crf, margin: float):
        self.model, self.margin = model, margin

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, tuple[list, list]]:
        """``{row: (base, added)}`` byte spans; rows without any are left out."""
        hit = np.flatnonzero(np.isin(data, _TRIGGERS)) if len(data) else np.zeros(0, np.int64)
        raw, out, jobs = data.tobytes(), {}, []
        at = set((np.searchsorted(offsets, hit, "right") - 1).tolist())
        at |= {int(np.searchsorted(offsets, m, "right")) - 1 for m in _marks(raw)}
        for i in sorted(at):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            text = raw[lo:hi]
            base = base_spans(text)
            out[i] = (base, [])
            mine = hit[np.searchsorted(hit, lo):np.searchsorted(hit, hi)] - lo
            for s, e in _windows(text, mine):
                toks = tokens(text, s, e)
                jobs += [(i, text, toks, *piece) for piece in _pieces(len(toks))]
        while jobs:
            jobs.sort(key=lambda j: j[4] - j[3])
            again, k = [], 0
            while k < len(jobs):
                some = jobs[k:k + 512]
                # long pieces: fewer at once
                some = some[:max(1, 512 * MAX_TOKENS // (some[-1][4] - some[-1][3]))]
                again += self._decode(some, out)
                k += len(some)
            jobs = again
        for _, added in out.values():
            added.sort(key=lambda x: (x[1], -x[2]))
            end, spans = 0, added[:]
            added.clear()
            for span in spans:  # pieces may read the same tokens twice
                if span[1] >= end:
                    added.append(span)
                    end = span[2]
        return {i: s for i, s in out.items() if s[0] or s[1]}

    def _decode(self, jobs: list, out: dict) -> list:
        """Adds the spans of ``jobs`` (row, text, tokens, first and last token
        of the piece, tokens where its spans begin); returns the longer pieces
        that are needed for spans that reach a cut."""
        lengths, again = np.array([j[4] - j[3] for j in jobs]), []
        x = _padded([shapes(j[1], j[2][j[3]:j[4]]) for j in jobs], 0)
        labels, scores = self.model.viterbi(x, lengths)
        move = self.model.move
        for n in np.flatnonzero((labels > 0).any(1)):
            i, text, whole, k0, k1, own0, own1 = jobs[n]
            toks, y = whole[k0:k1], labels[n, :lengths[n]]
            begin = np.flatnonzero(y % 2 == 1)
            begin = begin[(begin + k0 >= own0) & (begin + k0 < own1)]
            if k1 < len(whole) and len(begin) and (y[begin[-1] + 1:] == y[begin[-1]] + 1).all():
                again.append((i, text, whole, k0, min(len(whole), 2 * k1 - k0), own0, own1))
                continue
            for b in begin:
                e = b + 1
                while e < len(y) and y[e] == y[b] + 1:
                    e += 1
                s0, s1 = toks[b][0], toks[e - 1][1]
                kind = KINDS[(int(y[b]) - 1) // 2]
                own = scores[n, np.arange(b, e), y[b:e]].sum() + move[y[b:e - 1], y[b + 1:e]].sum()
                none = scores[n, b:e, 0].sum() + (e - b - 1) * move[0, 0]
                base, added = out[i]
                if (own - none > self.margin and _plausible(kind, text[s0:s1])
                        and all(s1 <= a or s0 >= z for _, a, z in base)):
                    added.append((kind, s0, s1))
        return again


def _joined(spans: list, points) -> str:
    return ",".join(f"{k}:{points(s)}:{points(e)}" for k, s, e in
                    sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def _spans_udf(model: Crf, margin: float):
    def run(batches):
        find = Finder(model, margin)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                n = len(offsets) - 1
                found = find.spans(data, offsets)
                code = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
                counts = np.zeros((n, 4), np.int64)
                sha, joined = [nothing] * n, [""] * n
                for i, (base, added) in found.items():
                    lo = int(offsets[i])
                    points = lambda b, lo=lo: int(code[lo + b] - code[lo])
                    for k, _, _ in base:
                        counts[i, KINDS.index(k)] += 1
                    sha[i] = hashlib.sha256(_joined(base, points).encode()).hexdigest()
                    joined[i] = _joined(base + added, points)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), *(pa.array(counts[:, k]) for k in range(4)),
                     pa.array(sha), pa.array(joined)],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return run


def find_pii(docs: DataFrame, model: Crf, margin: float = 2.0) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, base spans per
    kind (``n_email``, ``n_ip``, ``n_card``, ``n_phone``), ``base_sha256`` of
    the base spans and ``spans``, all of them, as ``kind:start:end`` in code
    points joined by commas, by kind as listed, then start. A null text is
    empty; a null ``doc_id`` and repeated rows are kept as they are; an empty
    table gives an empty result."""
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _spans_udf(model, margin), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                   "base_sha256 string, spans string")


def _redact_udf(model: Crf, margin: float, at: int):
    def run(batches):
        find = Finder(model, margin)
        for batch in batches:
            column, texts = batch.column(at), []
            for first, data, offsets in text_chunks(column):
                found, raw = find.spans(data, offsets), data.tobytes()
                for i in range(len(offsets) - 1):
                    text = raw[offsets[i]:offsets[i + 1]]
                    out, done = [], 0
                    for k, s, e in sorted(sum(found.get(i, ((), ())), start=[]) if i in found else [],
                                          key=lambda x: (x[1], -x[2])):
                        if e > done:
                            out += [text[done:max(s, done)], f"[{k.upper()}]".encode()] if s >= done else []
                            done = e
                    texts.append((b"".join(out) + text[done:]).decode("utf-8", "replace"))
            new = pa.array(texts, pa.string())
            null = np.asarray(column.is_null())
            if null.any():
                new = pa.array([None if z else t for z, t in zip(null, texts)], pa.string())
            yield batch.set_column(at, batch.schema.field(at).name, new)
    return run


def redact(docs: DataFrame, model: Crf, margin: float = 2.0) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets;
    overlapping spans are replaced together. All columns are kept."""
    return small_batches(docs).mapInArrow(_redact_udf(model, margin, docs.columns.index("text")), docs.schema)
