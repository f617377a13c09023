"""Byte-pair encoding and decoding of text streams in constant memory.

Encoding is a transducer with bounded lookahead. Text comes in pieces of any
size. It is cut into pre-tokens; a pre-token's bytes are merged in windows, and
a token leaves as soon as no later byte can change it:

* Apply the merge list in order, rule by rule, to a byte string and to a longer
  one that begins with it. Let ``D`` be a place up to which both have the same
  token ends, at first the shorter one's length. Rule ``(u, v)`` can spoil ``D``
  only by merging over it, in one string or both; ``u`` then ends at ``D`` in
  both (what lies before ``D`` is alike), and ``D`` falls back to the start of
  that ``u``: by ``len(u)`` bytes, once a rule.
* The next rule that merges over the new ``D`` comes later in the list, and its
  right part is a token that grew from ``u`` by merges on ``u``'s right: ``u`` is
  on its left spine.
* So ``D`` falls back at most by the heaviest chain of rules in which each rule's
  left part lies on the left spine of the next rule's right part.
  :func:`sufficient_lookahead` finds that chain by one pass over the list (320
  bytes for the 50,000 merges of the vocabulary used here).

A token that ends at least that many bytes before the end of what has been read
is final, and since token ends cut a string into parts that merge by themselves,
only the bytes after the last final token are kept. The argument needs a merge
list in which every part is a byte or the result of an earlier rule; any other
list is an error.

Decoding is the inverse machine: token bytes go through an incremental UTF-8
decoder that holds at most three bytes of an unfinished character; malformed
bytes give U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
BLOCK = 1 << 16  # characters looked at together
GROUP = 1 << 20  # characters of short texts looked up together
STEP = 1 << 12  # bytes a window takes beyond the lookahead
CACHED, CACHED_CHARS = 1 << 17, 64  # pre-tokens remembered, and their longest

# Pre-tokens of the byte-level vocabularies, and what continues
# one that began: white space, letters, numbers, other characters.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPACES = regex.compile(r"\p{White_Space}+")
RUNS = (SPACES, regex.compile(r"\p{L}+"), regex.compile(r"\p{N}+"), regex.compile(r"[^\p{White_Space}\p{L}\p{N}]+"))


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if printable, else the next unused one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(shown)))
    return [out[b] for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], start: set[str]) -> int:
    """Bytes (characters of the merge list) after which a token can't change
    any more; see the module doc. ``start`` holds the single symbols."""
    fall: dict[str, int] = {}  # most that D has fallen when this token starts at D
    lefts: dict[str, list[str]] = {}  # left parts that a token can come from
    worst = 0
    for u, v in merges:
        for part in (u, v):
            if part not in start and part not in lefts:
                raise ValueError(f"merge part {part!r} is made by no earlier merge")
        spine, seen, before = [v], {v}, 0
        while spine:
            t = spine.pop()
            before = max(before, fall.get(t, 0))
            for left in lefts.get(t, ()):
                if left not in seen:
                    seen.add(left)
                    spine.append(left)
        fall[u] = max(fall.get(u, 0), before + len(u))
        worst = max(worst, fall[u])
        made = lefts.setdefault(u + v, [])
        if u not in made:
            made.append(u)
    return worst


class Vocabulary:
    """Merge list, ids and special tokens of a byte-level vocabulary file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] is not None or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("not a plain byte-level vocabulary")
        ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        letters = byte_characters()
        self.lookahead = sufficient_lookahead(merges, set(letters))
        self.size = max(chain(ids.values(), (t["id"] for t in spec["added_tokens"]))) + 1
        self.of_byte = [ids[c] for c in letters]
        self.rank = {ids[u] * self.size + ids[v]: r for r, (u, v) in enumerate(merges)}
        self.made = [ids[u + v] for u, v in merges]
        back = {c: b for b, c in enumerate(letters)}
        self.token_bytes = [b""] * self.size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("special tokens that depend on their neighbours")
            self.special[t["content"]] = t["id"]
            self.token_bytes[t["id"]] = t["content"].encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.longest_special = max(map(len, names), default=0)
        self.window = self.lookahead + max(STEP, max(map(len, self.token_bytes)))
        self._ranks = RankTable(self.rank, len(self.made))
        self._made = np.append(self.made, -1)
        self._of_byte = np.array([*self.of_byte, -1])
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Token ids of a byte string by its own."""
        ids = [self.of_byte[b] for b in data]
        return self._merge_short(ids) if len(ids) <= 64 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, n, none = self.rank.get, self.size, len(self.made)
        ranks = [get(a * n + b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            ids[i:i + 2] = [self.made[r]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] * n + ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] * n + ids[i], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, n, end = self.rank.get, self.size, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i) for i in range(end - 1) if (r := get(ids[i] * n + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # an entry is stale when its pair has changed since
            if ids[i] < 0 or j >= end or get(ids[i] * n + ids[j]) != r:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (q := get(ids[i] * n + ids[k])) is not None:
                    heapq.heappush(heap, (q, i))
            h = before[i]
            if h >= 0 and (q := get(ids[h] * n + ids[i])) is not None:
                heapq.heappush(heap, (q, h))
        return [i for i in ids if i >= 0]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """:meth:`merge` of each word, all words a merge at a time: in every
        round each word's first pair of the lowest rank becomes one token.
        Columns are byte places; a token sits at its first byte's."""
        size = np.array([len(w) for w in words])
        width = int(size.max(initial=1))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width).astype(np.int64)
        place = np.arange(width + 1)
        byte = np.full((len(words), width + 1), 256)
        byte[:, :width] = np.where(place[:width] < size[:, None], raw, 256)
        ids = self._of_byte[byte].ravel()
        step = width + 1
        after, before = np.tile(place + 1, len(words)), np.tile(place - 1, len(words))
        none = len(self.made)
        ranks = np.full((len(words), step), none)
        ranks[:, :width] = self._ranks.of(ids.reshape(-1, step)[:, :-1], ids.reshape(-1, step)[:, 1:], self.size)
        ranks = ranks.ravel()
        live = np.arange(len(words))
        while len(live):
            own = ranks.reshape(-1, step)[live]
            i = own.argmin(axis=1)
            r = own[np.arange(len(live)), i]
            live, i, r = live[r < none], i[r < none], r[r < none]
            base = live * step
            i = base + i
            j = base + after[i]
            k = base + np.minimum(after[j], width)  # the last column stands for the end
            ids[i], ids[j], ranks[j] = self._made[r], -1, none
            after[i] = k - base
            before[k] = i - base
            ranks[i] = self._ranks.of(ids[i], ids[k], self.size)
            h = before[i]
            led = h >= 0
            h, i = (base + h)[led], i[led]
            ranks[h] = self._ranks.of(ids[h], ids[i], self.size)
        ids = ids.reshape(-1, step)
        there = ids >= 0
        flat, ends = ids[there].tolist(), np.cumsum(there.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pre_tokens) -> None:
        """Makes :meth:`packed` know these pre-tokens. What was learnt stays, in
        two generations of bounded size."""
        if len(self._young) >= CACHED:
            self._old, self._young = self._young, {}
        new = [w for w in set(pre_tokens).difference(self._young)]
        fresh: dict[int, list[str]] = {}
        for w in new:
            if (known := self._old.get(w)) is not None:
                self._young[w] = known
            else:
                fresh.setdefault((len(w) - 1) // 8, []).append(w)
        for words in fresh.values():
            for w, ids in zip(words, self.merge_many([w.encode() for w in words])):
                self._young[w] = pack(ids)

    def packed(self, parts: list[str | bytes]) -> bytes:
        """Ids of learnt pre-tokens and of parts that are packed already, as
        little-endian 32-bit numbers."""
        known = self._young
        return b"".join([known[p] if isinstance(p, str) else p for p in parts])


class RankTable:
    """Merge ranks by pair of ids, looked up for whole arrays: hash tables
    without collisions inside, each holding what the one before had no place for."""

    BITS = 19

    def __init__(self, rank: dict[int, int], none: int):
        self.none, self.tables = none, []
        keys, ranks = np.array(list(rank), np.int64), np.array(list(rank.values()), np.int64)
        while len(keys):
            mult = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
            at = self._slot(keys, mult)
            _, first = np.unique(at, return_index=True)
            held, values = np.full(1 << self.BITS, -1, np.int64), np.zeros(1 << self.BITS, np.int64)
            held[at[first]], values[at[first]] = keys[first], ranks[first]
            self.tables.append((mult, held, values))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]

    def _slot(self, keys: np.ndarray, mult: np.uint64) -> np.ndarray:
        return (keys.astype(np.uint64) * mult >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        keys = np.where((a >= 0) & (b >= 0), a * size + b, -2)
        out = np.full(keys.shape, self.none)
        for mult, held, values in self.tables:
            at = self._slot(keys, mult)
            out = np.where(held[at] == keys, values[at], out)
        return out


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class PieceEncoder:
    """Tokens of one pre-token whose bytes come in parts; keeps at most
    ``window`` bytes (and the part given)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, b""

    def feed(self, data: bytes) -> list[int]:
        v, out, at = self.vocabulary, [], 0
        while len(self.held) + len(data) - at > v.window:
            take = v.window - len(self.held)
            window = self.held + data[at:at + take]
            at += take
            end = 0
            for i in v.merge(window):
                to = end + len(v.token_bytes[i])
                if to > len(window) - v.lookahead:
                    break
                out.append(i)
                end = to
            self.held = window[end:]
        self.held += data[at:]
        return out

    def finish(self) -> list[int]:
        out = self.vocabulary.merge(self.held)
        self.held = b""
        return out


class TextEncoder:
    """Token ids of a text that comes in parts, packed as 32-bit numbers. Ids
    leave when they are final; about ``BLOCK`` characters are held at most,
    however long a word or a run of white space is."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.buffer = ""
        self.run: regex.Pattern | None = None  # what an unfinished pre-token goes on with
        self.piece: PieceEncoder | None = None

    def feed(self, text: str) -> bytes:
        out = []
        for at in range(0, len(text), BLOCK):
            out.append(self._packed(self.read(text[at:at + BLOCK])))
        return b"".join(out)

    def finish(self) -> bytes:
        return self._packed(self.read("", True))

    def _packed(self, parts: list[str | bytes]) -> bytes:
        self.vocabulary.learn(p for p in parts if isinstance(p, str))
        return self.vocabulary.packed(parts)

    def read(self, text: str, last: bool = False) -> list[str | bytes]:
        """What has become final: short pre-tokens as text, their ids to be
        looked up (for several texts together, where it pays), everything else
        as packed ids."""
        self.buffer += text
        if not last and len(self.buffer) < BLOCK:
            return []
        v, out, at = self.vocabulary, [], 0
        if v.special_pattern is not None:
            for m in v.special_pattern.finditer(self.buffer):
                self._segment(self.buffer[at:m.start()], True, out)
                out.append(pack([v.special[m.group()]]))
                at = m.end()
        used = self._segment(self.buffer[at:] if at else self.buffer, last, out)
        self.buffer = self.buffer[at + used:]
        return out

    def _whole(self, pre_token: str) -> str | bytes:
        if len(pre_token) <= CACHED_CHARS:
            return pre_token
        piece = PieceEncoder(self.vocabulary)
        return pack([*piece.feed(pre_token.encode()), *piece.finish()])

    def _segment(self, text: str, last: bool, out: list) -> int:
        """Adds to ``out``; returns the characters used. ``last``: the segment
        ends here."""
        at = 0
        # what follows may still change a pre-token that ends behind this place
        limit = len(text) if last else len(text) - max(2, self.vocabulary.longest_special)
        if self.run is not None:
            at = self._go_on(text, 0, limit, last, out)
            if self.run is not None:
                return at
        if last:
            words = PRE_TOKEN.findall(text, at)
            out.extend(map(self._whole, words) if max(map(len, words), default=0) > CACHED_CHARS else words)
            return len(text)
        for m in PRE_TOKEN.finditer(text, at):
            if m.end() > limit:
                break
            out.append(self._whole(m.group()))
            at = m.end()
        if len(text) - at >= BLOCK // 2:
            # a pre-token with no end in sight: its tokens leave as it goes on
            m = PRE_TOKEN.match(text, at)
            self.run = next(r for r in RUNS if r.match(text, m.end() - 1))
            self.piece = PieceEncoder(self.vocabulary)
            # a space before a word isn't part of the run
            lead = at + (self.run is not SPACES and text[at] == " ")
            out.append(pack(self.piece.feed(text[at:lead].encode())))
            at = self._go_on(text, lead, limit, last, out)
        return at

    def _go_on(self, text: str, at: int, limit: int, last: bool, out: list) -> int:
        m = self.run.match(text, at, limit)
        to = m.end() if m else at
        ends = to < limit or last
        if self.run is SPACES and to > at and not (last and to == len(text)):
            # white space leaves its last character to the word that follows
            to -= 1
        ids = self.piece.feed(text[at:to].encode())
        if ends:
            ids += self.piece.finish()
            self.run = self.piece = None
        out.append(pack(ids))
        return to


class TextDecoder:
    """Text of token ids that come in parts; an unfinished character's bytes
    (three at most) are the state."""

    def __init__(self, vocabulary: Vocabulary):
        self.of, self.machine = vocabulary.token_bytes.__getitem__, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.machine.decode(b"".join(map(self.of, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


# ---- Spark jobs

_IDS, _TEXT = "doc_id long, n_tokens long, ids array<int>", "doc_id long, text string"
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ROWS = 256


def _file(docs: DataFrame, vocabulary: str):
    """The vocabulary's file (some MB, fixed), read on the driver, as a broadcast value."""
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encoded(vocabulary: Vocabulary, texts: list[str]):
    """For each text its packed ids, part after part. Texts of up to ``BLOCK``
    characters are looked up in groups."""
    group: list[list[str | bytes]] = []

    def known():
        vocabulary.learn(p for parts in group for p in parts if isinstance(p, str))
        out = [[vocabulary.packed(parts)] for parts in group]
        group.clear()
        return out

    held = 0
    for text in texts:
        if len(text) > BLOCK:
            yield from known()
            held = 0
            yield _stream(vocabulary, text)
            continue
        group.append(TextEncoder(vocabulary).read(text, True))
        held += len(text)
        if held > GROUP:
            yield from known()
            held = 0
    yield from known()


def _stream(vocabulary: Vocabulary, text: str):
    encoder = TextEncoder(vocabulary)
    for at in range(0, len(text), BLOCK):
        yield encoder.feed(text[at:at + BLOCK])
    yield encoder.finish()


def encode_texts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of each row's whole text, special
    tokens in the text included. A null text is empty and has no ids; repeated
    rows and null ids are rows of their own; other columns aren't read. The
    rows stay where they are: no shuffle."""
    file = _file(docs, vocabulary)

    def run(batches):
        v = Vocabulary(file.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                packed = [b"".join(parts) for parts in encoded(v, part.column(1).to_pylist())]
                n = np.array([len(p) // 4 for p in packed], np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()),
                                               pa.array(np.frombuffer(b"".join(packed), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), ids], names=["doc_id", "n_tokens", "ids"])
    return _keyed(docs).mapInArrow(run, _IDS)


def decode_ids(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; null ids
    give the empty text, an id outside the vocabulary is an error."""
    file = _file(rows, vocabulary)

    def run(batches):
        v = Vocabulary(file.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part, texts = batch.slice(lo, ROWS), []
                for ids in part.column(1).to_pylist():
                    if ids and min(ids) < 0:
                        raise ValueError("ids must be 0 or more")
                    d = TextDecoder(v)
                    texts.append(d.feed(ids or []) + d.finish())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, _TEXT)


def encode_and_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Each row's text encoded and decoded again, part by part: ``doc_id``,
    ``n_tokens``, the sha256 of the ids (little-endian unsigned 32-bit numbers)
    and of the decoded text in UTF-8. Nulls as in :func:`encode_texts`."""
    file = _file(docs, vocabulary)

    def run(batches):
        v = Vocabulary(file.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part, out = batch.slice(lo, ROWS), []
                for doc_id, parts in zip(part.column(0).to_pylist(), encoded(v, part.column(1).to_pylist())):
                    decoder, n = TextDecoder(v), 0
                    of_ids, of_text = hashlib.sha256(), hashlib.sha256()
                    for packed in parts:
                        n += len(packed) // 4
                        of_ids.update(packed)
                        of_text.update(decoder.feed(np.frombuffer(packed, "<u4").tolist()).encode())
                    of_text.update(decoder.finish().encode())
                    out.append((doc_id, n, of_ids.hexdigest(), of_text.hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _keyed(docs).mapInArrow(run, _DIGEST)
