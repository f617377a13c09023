"""The streaming encoder and decoder against the tokenizers library."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bayline.llm import bpe_stream as bpe
from bayline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    with open(bpe.VOCABULARY, "rb") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def streamed(vocabulary, parts):
    e = bpe.TextEncoder(vocabulary)
    return ids_of(b"".join([*map(e.feed, parts), e.finish()]))


def test_every_character_is_cut_as_the_library_cuts_it(vocabulary, library):
    for lo in range(0, 0x110000, 1 << 10):
        text = "".join(f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in range(lo, lo + (1 << 10)) if not 0xD800 <= c < 0xE000)
        assert streamed(vocabulary, [text]) == library.encode(text, add_special_tokens=False).ids, hex(lo)


@pytest.mark.parametrize("block", [64, 300])
def test_any_cutting_of_the_stream_gives_the_same_ids(vocabulary, library, monkeypatch, block):
    """Small blocks and windows: words, white space and special tokens run over many."""
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(vocabulary, "window", vocabulary.lookahead + 130)
    r = random.Random(block)
    for alphabet in ("ab", "the ", "aehtinors", "  \n\tx", "'stre ' ll", "1234567890 ", "<|endoftext|> a", "é世🙂 a", "-=_. "):
        for size in (0, 1, 70, 900, 4000):
            text = "".join(r.choice(alphabet) for _ in range(size))
            text += r.choice(["", "<|endoftext|>", "<|endof"]) + "the" * r.randrange(300) + " " * r.randrange(300) + r.choice(["", "x"])
            parts, at = [], 0
            while at < len(text):
                k = r.choice([1, 3, 50, 1000])
                parts.append(text[at:at + k])
                at += k
            assert streamed(vocabulary, parts) == library.encode(text, add_special_tokens=False).ids, (alphabet, size)


def test_state_stays_bounded_on_a_word_without_end(vocabulary, library):
    text = "lorem" * 200_000
    e, held, out = bpe.TextEncoder(vocabulary), 0, []
    for at in range(0, len(text), 10_000):
        out.append(e.feed(text[at:at + 10_000]))
        held = max(held, len(e.buffer) + (len(e.piece.held) if e.piece else 0))
    out.append(e.finish())
    assert held < bpe.BLOCK + 10_000 + vocabulary.window
    ids = ids_of(b"".join(out))
    assert len(ids) > 100_000 and ids == library.encode(text, add_special_tokens=False).ids


def by_rules(merges, text):
    """Rule by rule, each over the whole text."""
    tokens = list(text)
    for u, v in merges:
        i, out = 0, []
        while i < len(tokens):
            if tokens[i:i + 2] == [u, v]:
                out.append(u + v)
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


@pytest.mark.parametrize("seed", range(12))
def test_lookahead_suffices(seed):
    """Small merge lists: no extension changes a token that ends the
    lookahead before the end."""
    r = random.Random(seed)
    made, merges = ["a", "b"], []
    while len(merges) < 5:
        u, v = r.choice(made), r.choice(made)
        if u + v not in made:
            made.append(u + v)
            merges.append((u, v))
    look = bpe.sufficient_lookahead(merges, {"a", "b"})
    assert look >= 1
    for n in range(1, 11):
        for text in map("".join, itertools.product("ab", repeat=n)):
            ends = set(itertools.accumulate(map(len, by_rules(merges, text))))
            for more in map("".join, itertools.product("ab", repeat=3)):
                longer = set(itertools.accumulate(map(len, by_rules(merges, text + more))))
                assert {x for x in ends if x <= n - look} == {x for x in longer if x <= n - look}


def test_lookahead_of_the_vocabulary_and_of_bad_lists(vocabulary):
    assert vocabulary.lookahead == 320
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "a"), ("a", "b")], {"a", "b"})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=70).filter(lambda b: b), min_size=1, max_size=8))
def test_words_merge_alike_alone_and_together(vocabulary_once, words):
    assert vocabulary_once.merge_many(words) == [vocabulary_once.merge(w) for w in words]


@pytest.fixture(scope="module")
def vocabulary_once(vocabulary):
    return vocabulary


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 50256), max_size=30), cut=st.integers(0, 30))
def test_decoder_equals_library_on_any_ids(vocabulary_once, library_once, ids, cut):
    d = bpe.TextDecoder(vocabulary_once)
    got = d.feed(ids[:cut]) + d.feed(ids[cut:]) + d.finish()
    assert got == library_once.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def library_once(library):
    return library


def wanted(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def as_rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()),
                  key=lambda r: (r[0] is not None, r))


def test_odd_rows(spark, library, odd_docs, no_docs):
    more = spark.createDataFrame([(100, "a<|endoftext|>b <|endoftext|>"), (101, "z" * 300_000), (102, " " * 100_000 + "x"),
                                  (103, "it's they'll 'tis\r\n\x1c\x85　 9¾ Ⅷ")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    want = wanted(library, [(r.doc_id, r.text) for r in docs.collect()])
    assert as_rows(bpe.encode_and_decode(docs)) == want
    clash = docs.selectExpr("doc_id", "text", "1 as n_tokens", "'x' as ids", "2 as ids_sha256")
    assert as_rows(bpe.encode_and_decode(clash)) == want
    assert bpe.encode_and_decode(no_docs).collect() == [] == bpe.encode_texts(no_docs).collect()


def test_ids_and_texts_as_tables(spark, library, odd_docs):
    encoded = bpe.encode_texts(odd_docs)
    for r in encoded.join(odd_docs.where("doc_id > 3").select("doc_id", "text"), "doc_id").collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    back = {r.doc_id: r.text for r in bpe.decode_ids(encoded).collect()}
    for r in odd_docs.collect():
        assert back[r.doc_id] == (r.text or "") or r.doc_id is None
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode_ids(none).collect()] == ["", ""]


def test_registered_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = wanted(library, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert as_rows(QUERIES["op11_bpe_stream"](spark, SF0001)) == want
