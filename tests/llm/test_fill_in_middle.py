"""Fill-in-middle cuts against the token pattern, texts against their samples."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF0001, SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, duck

from bayline.llm import fill_in_middle as fim
from bayline.llm.queries import ORACLE_SQL, QUERIES
from bayline.llm.words import text_chunks

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = st.text(alphabet=" \t\n\x0bab,é世 🙂<P>SM", max_size=40)


def brute_boundaries(text):
    return [0, *(m.end() for m in TOKEN.finditer(text))]


def index_of(texts, bound=fim.BOUND):
    (first, data, offsets), = text_chunks(pa.array(texts), 1 << 30)
    return fim.RankIndex(*fim.token_boundaries(data, offsets), bound)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6), st.sampled_from([0, 1, 127]))
def test_every_boundary_is_exact(texts, bound):
    index = index_of(texts, bound)
    for d, t in enumerate(texts):
        want = brute_boundaries(t)
        assert index.counts()[d] == len(want) - 1
        got = index.boundary(np.full(len(want), d), np.arange(len(want)))
        assert got.tolist() == want


def test_uneven_text_takes_more_pieces_and_stays_exact():
    text = "a " * 3000 + "b" * 5000 + " " + "long-word " * 2000 + "\n" * 900
    index = index_of([text, "x y z"])
    want = brute_boundaries(text)
    assert index.boundary(np.zeros(len(want), int), np.arange(len(want))).tolist() == want
    own = index.of_text(0)
    assert 2 < len(own["pieces"]) < len(want) // 10
    assert len(index.of_text(1)["pieces"]) == 1
    # the stored form alone gives the boundaries back
    res = np.frombuffer(own["residuals"], np.int8)
    for p in own["pieces"]:
        r = np.arange(p["rank"], p["last_rank"] + 1)
        line = p["value"] + (r - p["rank"]) * (p["last_value"] - p["value"]) // max(1, p["last_rank"] - p["rank"])
        assert (line + res[r]).tolist() == want[p["rank"]:p["last_rank"] + 1]


@settings(max_examples=200, deadline=None)
@given(PIECES, st.integers(0, 40), st.integers(0, 40), st.sampled_from(["plain", "psm", "spm"]))
def test_texts_come_back(text, i, j, form):
    if any(m in text for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
        form = "plain"
    a, b = sorted((min(i, len(text)), min(j, len(text))))
    assert fim.restore(fim.transform(text, form, a, b), form) == text


def brute_row(doc_id, text, seed=42):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    ends = brute_boundaries(text)
    n = len(ends) - 1
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = ends[x], ends[y]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", text
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", text


def key(row):
    return tuple((v is not None, v) for v in row)


def test_samples_of_odd_rows(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(
        ["a <P> b c d", "<S>", "x<M>y z", "  no break", " lead", "trail \n", "<<P <S> > q r"] * 8)],
        "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    want = sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=key)
    got = sorted(map(tuple, fim.fill_in_middle(docs).collect()), key=key)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    # the operator's own columns may exist in the input
    clash = docs.selectExpr("doc_id", "text", "1 as n", "'x' as form", "2 as output", "3 as h")
    assert sorted(map(tuple, fim.fill_in_middle(clash).collect()), key=key) == want
    assert fim.fill_in_middle(no_docs).collect() == []
    assert fim.rank_index(no_docs).collect() == []


def test_stored_index_matches_texts(spark, odd_docs):
    rows = fim.rank_index(odd_docs.where("doc_id = 11")).collect()
    text = odd_docs.where("doc_id = 11").first().text
    assert rows[0].n == len(brute_boundaries(text)) - 1 == len(rows[0].residuals) - 1


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_registered_query_equals_its_sql(spark, sf):
    name = "op12_fill_in_middle"
    ok, msg = compare(QUERIES[name](spark, sf), ORACLE_SQL[name], duck(sf))
    assert ok, msg
