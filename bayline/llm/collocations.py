"""Phrase collocations by the stripes pattern.

A stripe is an associative counter of next words, keyed by a prefix. Each word
occurrence adds one to the stripe of its place: with ``x y z`` the words from
there on, to ``z`` in the stripe of ``x y``; a piece's end counts as a word, so
nothing is left out. Stripes of one prefix merge by adding them elementwise, and
everything follows from the merged ones: an entry is the count of a three-word
phrase, a stripe's sum that of its prefix, its largest entry what decides
whether the prefix is subsumed to the right. The empty prefix has a stripe too,
the words' own counts; it is cut by next word, as no task could hold it.

Spark job: documents are read in groups of some MB of one language. A group's
stripes leave as rows, one for each part that a hash deals prefixes to, with the
words spelt once and the entries as arrays of places in that list. So a pair of
words that holds a third of the corpus crosses the shuffle once a group, next
word by next word. One shuffle on the part, and each part's rows are added up:
words by their spelling, not by hash. Parts are as many as keep about
``PART_BYTES`` of text in each, whatever the corpus' size. What is left, phrases
at or over the least count, is a small table; scores and ranks are joins over it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.llm.staging import shuffle_partitions, staged, within_small_batches
from bayline.llm.words import WordHasher, mix64, text_buffer

GROUP_BYTES, HELD_BYTES = 8 << 20, 32 << 20  # text of one language, of all, held by a task
PART_BYTES = 4 << 20
MERGE_ROWS = 1 << 19  # entries of a part held before they are added up
BITS = 21  # three places below 2**21 fit one key
NO_LANG = "und"
# A word's bytes are neither blanks nor breaks; A-Z are folded.
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """``(words, piece)``: the words of the texts in order, folded, and a number
    for the piece that each is in."""
    data, ends, at = [], [np.zeros(1, np.int64)], 0
    for t in texts:
        raw, off = text_buffer(t)
        data.append(raw[off[0]:off[-1]])
        ends.append(off[1:] - off[0] + at)
        at = ends[-1][-1]
    data, offsets = np.concatenate(data), np.concatenate(ends)
    kind = _KIND[data]
    solid = kind == 0
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid & (cut[:-1] | ~np.append(False, solid[:-1])))
    stops = np.flatnonzero(solid & (cut[1:] | ~np.append(solid[1:], False))) + 1
    # breaks and texts begun so far: alike for the words of one piece only
    piece = (np.cumsum(kind == 2) + np.cumsum(cut[:-1]))[starts]
    spelt = _LOWER[data[solid]]
    places = np.append(0, np.cumsum(stops - starts))
    if len(spelt) < 1 << 31:
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(spelt)])
    else:
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(spelt)])
    return words, piece


def add_up(a, b, c, n):
    """Entries (prefix ``a b``, next ``c``, count) with equal ones added, sorted."""
    if len(a) and max(x.max() for x in (a, b, c)) < 1 << BITS:
        key = a.astype(np.int64) << 2 * BITS
        key |= b.astype(np.int64) << BITS
        key |= c
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    else:
        order = np.lexsort((c, b, a))
        s = [x[order] for x in (a, b, c)]
        first = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in s], axis=0))[:len(order)])
    if not len(order):
        return a, b, c, n
    at = order[first]
    return a[at], b[at], c[at], np.add.reduceat(n[order], first)


def stripes_of(texts: list[pa.Array]):
    """``(words, a, b, c, n)``: stripes of some texts as entries. Places count
    from 1 in ``words``; 0 is a piece's end, or in ``a`` and ``b`` the empty prefix."""
    spelt, piece = words_of(texts)
    coded = spelt.dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    n_words = len(coded.dictionary)
    size = len(at)
    ahead = np.append(at, [0, 0])
    number = np.append(piece, [-1, -1])
    b = np.where(number[1:size + 1] == piece, ahead[1:size + 1], 0)
    c = np.where(number[2:] == piece, ahead[2:], 0)
    if n_words < 1 << BITS:
        key, n = np.unique(at << 2 * BITS | b << BITS | c, return_counts=True)
        low = (1 << BITS) - 1
        entries = key >> 2 * BITS, key >> BITS & low, key & low, n
    else:
        entries = add_up(at, b, c, np.ones(size, np.int64))
    none = np.zeros(n_words, np.int64)
    own = none, none, np.arange(1, n_words + 1), np.bincount(at, minlength=n_words + 1)[1:]
    return (coded.dictionary, *(np.concatenate([x, y]) for x, y in zip(own, entries)))


_ROW = "part int, lang string, words string, a array<int>, b array<int>, c array<int>, n array<int>"
_MERGED = "lang string, w1 string, w2 string, w3 string, n long, longer long"


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A hash of the language and of each word; place 0 stands for the end."""
    seed = np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "big"))
    if not len(words):
        return np.array([seed])
    raw = np.frombuffer(" ".join(words.to_pylist()).encode(), np.uint8)
    h = WordHasher().words(raw, np.array([0, len(raw)]))[0]
    return mix64(np.append(np.uint64(1), h) ^ seed)


def _rows_of(lang: str, texts: list[pa.Array], parts: int):
    """A group's stripes, one row for each part that some of them belong to."""
    words, a, b, c, n = stripes_of(texts)
    if not len(words):
        return
    h = _hashes(words, lang)
    # the empty prefix's stripe is cut by next word
    key = np.where(a == 0, h[c], mix64(h[a] * np.uint64(3) + h[b]))
    part = (key % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for lo, hi in zip(first, np.append(first[1:], len(part))):
        own = order[lo:hi]
        used, place = np.unique(np.concatenate([a[own], b[own], c[own]]), return_inverse=True)
        place = place + (used[0] != 0)
        spelt = words.take(pa.array(used[used > 0] - 1)).to_pylist()
        x, y, z = np.split(place, 3)
        yield int(part[lo]), lang, " ".join(spelt), x, y, z, n[own]


def _record(rows: list) -> pa.RecordBatch:
    ints = lambda k: pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum([len(r[k]) for r in rows])), pa.int32()),
        pa.array(np.concatenate([r[k] for r in rows]).astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
         pa.array([r[2] for r in rows], pa.string()), *(ints(k) for k in (3, 4, 5, 6))],
        names=["part", "lang", "words", "a", "b", "c", "n"])


def _batched(rows, n_bytes: int = 8 << 20):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2]) + 16 * len(r[3])
        if size > n_bytes:
            yield _record(held)
            held, size = [], 0
    if held:
        yield _record(held)


def _stripe_udf(parts: int):
    def groups(batches):
        held: dict[str, list] = {}  # language -> [bytes, arrays of texts]
        total = 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column(1).filter(pc.equal(langs.indices, k))
                bounds = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
                lo = 0
                while lo < len(texts):
                    own = held.setdefault(lang, [0, []])
                    before = int(bounds[lo - 1]) if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(bounds, before + GROUP_BYTES - own[0], "right")))
                    size = int(bounds[hi - 1]) - before
                    own[0] += size
                    total += size
                    own[1].append(texts.slice(lo, hi - lo))
                    lo = hi
                    if own[0] >= GROUP_BYTES:
                        total -= own[0]
                        yield lang, held.pop(lang)[1]
            # the next batch replaces this one: few bytes stay behind
            if total > HELD_BYTES:
                yield from ((lang, texts) for lang, (_, texts) in held.items())
                held, total = {}, 0
        yield from ((lang, texts) for lang, (_, texts) in held.items())

    def run(batches):
        yield from _batched(row for lang, texts in groups(batches) for row in _rows_of(lang, texts, parts))
    return run


class Stripes:
    """Stripes of one language in one part, added up as they come."""

    def __init__(self):
        self.words, self.entries = [], []
        self.size, self.limit = 0, MERGE_ROWS

    def add(self, words: pa.Array, a, b, c, n) -> None:
        self.words.append(words)
        self.entries.append((a, b, c, n))
        self.size += len(a)
        if self.size > self.limit:
            self.merge()
            # what doesn't shrink isn't merged again at every row
            self.limit = max(MERGE_ROWS, 2 * self.size)

    def merge(self) -> None:
        coded = pa.concat_arrays(self.words).dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False) + np.int32(1)
        columns, at = ([], [], [], []), 0
        for words, entry in zip(self.words, self.entries):
            own = np.append(np.int32(0), place[at:at + len(words)])
            at += len(words)
            for held, x in zip(columns, entry[:3]):
                held.append(own[x])
            columns[3].append(entry[3])
        self.words, self.entries = [coded.dictionary], []
        merged = add_up(*(np.concatenate(x) for x in columns[:3]), np.concatenate(columns[3], dtype=np.int64))
        self.entries, self.size = [merged], len(merged[0])

    def phrases(self, lang: str, least: int) -> pa.RecordBatch:
        """Words, two-word prefixes (with the count of their most frequent
        longer phrase) and three-word phrases of at least ``least`` occurrences,
        and one row with the number of words, its ``w1`` null."""
        self.merge()
        (a, b, c, n), spelt = self.entries[0], self.words[0]
        word = np.flatnonzero(a == 0)
        first = np.flatnonzero((a > 0) & (b > 0) & np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)])
        inside = (a > 0) & (b > 0)
        # entries of other prefixes lie before the first stripe or between two
        pair_n = np.add.reduceat(np.where(inside, n, 0), first) if len(first) else n[:0]
        longer = np.maximum.reduceat(np.where(inside & (c > 0), n, 0), first) if len(first) else n[:0]
        often = pair_n >= least
        triple = np.flatnonzero(inside & (c > 0) & (n >= least))
        total = int(n[word].sum())
        word = word[n[word] >= least]
        first, pair_n, longer = first[often], pair_n[often], longer[often]
        w1, w2, w3 = (np.concatenate(x) for x in (
            (c[word], a[first], a[triple], [0]), (0 * word, b[first], b[triple], [0]), (0 * word, 0 * first, c[triple], [0])))
        none = pa.array([None], pa.string())
        spell = pa.concat_arrays([none, spelt])
        counts = np.concatenate([n[word], pair_n, n[triple], [total]])
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), *(spell.take(pa.array(w.astype(np.int64))) for w in (w1, w2, w3)),
             pa.array(counts, pa.int64()), pa.array(np.concatenate([0 * word, longer, 0 * triple, [0]]), pa.int64())],
            names=["lang", "w1", "w2", "w3", "n", "longer"])


def _merge_udf(least: int):
    def run(batches):
        part, held = None, {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            words = pc.split_pattern(batch.column(2), " ")
            lists = [batch.column(k) for k in (3, 4, 5, 6)]
            for i, p in enumerate(batch.column(0).to_pylist()):
                if p != part:
                    yield from (s.phrases(lang, least) for lang, s in held.items())
                    part, held = p, {}
                held.setdefault(names[i], Stripes()).add(
                    words[i].values, *(x[i].values.to_numpy(zero_copy_only=False) for x in lists))
        yield from (s.phrases(lang, least) for lang, s in held.items())
    return run


def count_phrases(docs: DataFrame, least: int = 10) -> DataFrame:
    """Counts over all documents by language (null: ``und``): ``lang``, ``w1``,
    ``w2``, ``w3``, ``n``, ``longer``. Words have ``w1`` alone, two-word phrases
    no ``w3``; ``longer`` is the count of the most frequent phrase that goes on
    after the two. Phrases of fewer than ``least`` occurrences are left out,
    and rows without ``w1`` add up to the number of words."""
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(shuffle_partitions(docs), -(-int(size) // PART_BYTES))
    stripes = d.mapInArrow(_stripe_udf(parts), _ROW)
    return stripes.repartition("part").sortWithinPartitions("part").mapInArrow(_merge_udf(least), _MERGED)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10**6 * a * a / (l * r)) in exact decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    product = F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)).cast("decimal(31,0)")
    return F.call_function("div", product, (wide(left) * wide(right)).cast("decimal(38,0)")).cast("long")


def scored_phrases(counts: DataFrame, least: int = 10, subsumed_percent: int = 50) -> DataFrame:
    """Candidates of :func:`count_phrases` that no longer one subsumes, with the
    cut that scores lowest (the earlier of equal ones): ``lang``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``."""
    totals = counts.where("w1 is null").groupBy("lang").agg(F.sum("n").alias("total"))
    words = counts.where("w1 is not null and w2 is null").select("lang", "w1", F.col("n").alias("f"))
    pairs = counts.where("w2 is not null and w3 is null").select("lang", "w1", "w2", F.col("n").alias("f"), "longer")
    triples = counts.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))

    def word(name: str, value: str) -> DataFrame:
        return words.select("lang", F.col("w1").alias(name), F.col("f").alias(value))

    def pair(first: str, second: str, value: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("f").alias(value))

    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("led"))
    two = (pairs.join(before, ["lang", "w1", "w2"], "left")
           .where(100 * F.greatest(F.when(F.col("longer") >= least, F.col("longer")).otherwise(0), F.coalesce("led", F.lit(0)))
                  < subsumed_percent * F.col("f"))
           .join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
           .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), "l", "r",
                   _score(F.col("f"), F.col("l"), F.col("r")).alias("score")))
    three = (triples.join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"])
             .join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
             .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(*(
                 F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                          F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2))).alias("cut"))
             .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    return (two.unionByName(three).join(totals, "lang")
            .select("lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, subsumed_percent: int = 50) -> DataFrame:
    """The ``top`` best phrases of two or three words of each language: ``lang``,
    ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A null text is empty, a null language is ``und``; ``doc_id`` isn't read, so
    repeated rows count each time. Equal scores are ordered by ``a``, then by the
    phrase's bytes: no ties. Other columns aren't read; an empty table gives no
    rows. Counts are staged in the shared folder, as several joins read them."""
    with within_small_batches(docs.sparkSession):
        counts = staged(count_phrases(docs, least), "phrase-counts")
    scored = scored_phrases(counts, least, subsumed_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in shares first, so that none is one task's
    shares = F.pmod(F.xxhash64("phrase"), F.lit(max(1, shuffle_partitions(docs))))
    best = scored.withColumn("share", shares)
    best = best.withColumn("own", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("own") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return (best.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations_sql(table: str = "documents", top: int = 2000, least: int = 10) -> str:
    """DuckDB SQL of :func:`collocations`."""
    upper = "".join(map(chr, range(65, 91)))
    return f"""
with p as (
  select row_number() over () as piece, lang, words from (
    select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(string_split_regex(
             translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\n\\x0B\\f\\r]')), '[^ \\t]+') as words
    from {table}) where len(words) > 0),
w as (
  select lang, unnest(words) as w1, unnest(list_concat(words[2:], [null])) as w2,
         unnest(list_concat(words[3:], [null, null])[1:len(words)]) as w3 from p),
t as (select lang, cast(count(*) as bigint) as n from w group by lang),
f1 as (select lang, w1, cast(count(*) as bigint) as f from w group by all),
f2 as (select lang, w1, w2, cast(count(*) as bigint) as f from w where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, cast(count(*) as bigint) as f from w where w3 is not null group by all having count(*) >= {least}),
sub as (select lang, w1, w2, max(f) as m from (
          select lang, w1, w2, f from f3 union all select lang, w2 as w1, w3 as w2, f from f3) group by all),
two as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, x.f as l, y.f as r, 1 as k
  from f2 p join f1 x on p.lang = x.lang and p.w1 = x.w1 join f1 y on p.lang = y.lang and p.w2 = y.w1
  left join sub s on p.lang = s.lang and p.w1 = s.w1 and p.w2 = s.w2
  where p.f >= {least} and 100 * coalesce(s.m, 0) < 50 * p.f),
cuts as (
  select * from two
  union all
  select q.lang, q.w1 || ' ' || q.w2 || ' ' || q.w3, q.f, x.f, y.f, 1
  from f3 q join f1 x on q.lang = x.lang and q.w1 = x.w1 join f2 y on q.lang = y.lang and q.w2 = y.w1 and q.w3 = y.w2
  union all
  select q.lang, q.w1 || ' ' || q.w2 || ' ' || q.w3, q.f, x.f, y.f, 2
  from f3 q join f2 x on q.lang = x.lang and q.w1 = x.w1 and q.w2 = x.w2 join f1 y on q.lang = y.lang and q.w3 = y.w1),
sc as (
  select *, cast((1000000::hugeint * a * a) // (l::hugeint * r) as bigint) as score from cuts),
one as (
  select *, row_number() over (partition by lang, phrase order by score, k) as pick from sc),
rk as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from one where pick = 1)
select rk.lang, cast(rank as bigint) as rank, phrase, a, l, r, t.n, score
from rk join t on rk.lang = t.lang where rank <= {top}"""
