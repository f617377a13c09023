"""Collocations against a plain count of all phrases, and against SQL."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from conftest import SF0001, SF001
from oracle import compare, duck

from bayline.llm import collocations as col
from bayline.llm.queries import ORACLE_SQL, QUERIES

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=2000, least=10):
    """rows: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for p, a in f.items():
        if len(p) < 3 or a < least:
            continue
        longer = [x for q, x in f.items() if len(q) == 4 and len(p) == 3 and x >= least and q[0] == p[0] and p[1:] in (q[1:3], q[2:])]
        if any(100 * x >= 50 * a for x in longer):
            continue
        cuts = []
        for k in range(2, len(p)):
            left, right = f[p[:k]], f[(p[0], *p[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        s, _, left, right = min(cuts)
        out.append((p[0], " ".join(p[1:]), a, left, right, n[p[0]], s))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(ranked)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def invented(n, seed):
    r = random.Random(seed)
    words = ["Aa", "b", "É", "世界", "🙂", "x\x00y", "\x1c", "long-word", "c", "d"]
    joins = [" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\r\n", "!?", " ; "]
    return [("".join(r.choice(words) + r.choice(joins) for _ in range(r.randrange(60))), r.choice(["en", "fr", None, "d e"]))
            for _ in range(n)]


def test_counts_scores_and_subsumption_by_hand(spark):
    rows = [("new York city.", "en")] * 12 + [("new york", "en")] * 3 + [("york", "en"), ("a a a a", "fr")] * 10
    docs = spark.createDataFrame(rows, "text string, lang string")
    # "new york" (15) and "york city" (12) lie in "new york city" (12); "a a a a" holds "a a a" twice
    assert got(col.collocations(docs)) == [("en", 1, "new york city", 12, 15, 12, 52, 800_000),
                                           ("fr", 1, "a a a", 20, 40, 30, 40, 333_333)] == brute(rows)


@pytest.mark.parametrize("group,part,merge,bits", [(8 << 20, 16 << 20, 2 << 20, 21), (300, 400, 40, 21), (300, 4000, 10, 3)])
def test_any_cutting_gives_the_brute_result(spark, monkeypatch, group, part, merge, bits):
    """Small groups, many parts, merges after few entries and places too many
    for one key change nothing."""
    for name, value in (("GROUP_BYTES", group), ("PART_BYTES", part), ("MERGE_ROWS", merge), ("BITS", bits)):
        monkeypatch.setattr(col, name, value)
    rows = invented(200, 3) + [("b c d " * 3000, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert got(col.collocations(docs, least=4)) == brute(rows, least=4)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()] * 11
    docs = odd_docs.selectExpr("text", "lang", "1 as rank", "'x' as w1", "2 as n", "explode(sequence(1, 11)) as a")
    assert got(col.collocations(docs)) == brute(rows)
    assert col.collocations(no_docs).collect() == []
    empty = no_docs.sparkSession.createDataFrame([(None, None), ("", "en"), (" .,\n", "en")], "text string, lang string")
    assert col.collocations(empty).collect() == []


def test_top_of_each_language_is_the_best(spark):
    rows = invented(120, 9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert got(col.collocations(docs, top=3, least=2)) == brute(rows, top=3, least=2)


def test_scores_are_exact_past_64_bits(spark):
    big = [(3_000_000_017, 3_000_000_019, 3_000_000_021), (10**12, 10**12, 10**12 + 1), (10, 10**12, 10**12), (7, 7, 7)]
    df = spark.createDataFrame(big, "a long, l long, r long")
    from pyspark.sql import functions as F
    out = [r[0] for r in df.select(col._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert out == [1_000_000 * a * a // (x * y) for a, x, y in big]


def test_hot_pair_crosses_once_a_group(spark):
    """A pair that fills the corpus is one entry of a group's rows, not a row
    an occurrence."""
    words, a, b, c, n = col.stripes_of([pa.array(["the the " * 50_000 + "end"])])
    assert len(a) <= 6 and int(n[a > 0].sum()) == 100_001 == int(n[a == 0].sum())
    docs = spark.range(40).selectExpr("repeat('the the ', 2000) as text", "'en' as lang")
    rows = docs.mapInArrow(col._stripe_udf(7), col._ROW)
    assert rows.count() <= 7 * docs.rdd.getNumPartitions()


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_registered_query_equals_its_sql(spark, sf):
    name = "op13_collocations"
    ok, msg = compare(QUERIES[name](spark, sf), ORACLE_SQL[name], duck(sf))
    assert ok, msg
