"""Secret scan with a trigram index, in DataFrame functions only.

Each rule's regex gives a Boolean query over lower-cased trigrams that any
match must contain (:func:`trigram_query`): an OR of trigram sets. The index
holds a posting ``(trigram, text)`` for the trigrams that some rule asks for,
from the whole of every text. A text is a candidate for a rule when all
trigrams of one of its sets are there, which is an intersection of postings
counted per set; only candidates are searched with the rule's regex. A rule
without mandatory trigrams (``hex``) searches every text.

Positions come from the texts between matches: ``split`` and
``regexp_extract_all`` use the same regex, so running sums of their lengths
are the matches' starts, in code points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``value_group`` of ``min_value`` or more characters; shorter matches
    are dropped without another try inside them."""

    kind: str
    regex: str
    base: bool = False
    value_group: int = 0
    min_value: int = 0


# The first three are the contract's base kinds, in its order. A minimum that
# covers the whole of a run is written into the regex: a shorter run has no
# longer one inside it.
RULES = (
    Rule("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         True, 1, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}", True),
    Rule("hex", "[0-9a-f]{24,}", True),
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
)

MAX_STRINGS = 64


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _both(a: set, b: set) -> set:
    """AND of two ORs of trigram sets."""
    return _least({x | y for x in a for y in b})


def _least(sets: set) -> set:
    """Without sets that hold another set of the OR."""
    return {x for x in sets if not any(y < x for y in sets)}


_ALWAYS = {frozenset()}


def _walk(items) -> tuple[set[str] | None, set]:
    """``(the strings matched, if few, else None; the trigram query)``."""
    exact, cur, query = True, {""}, _ALWAYS

    def flush():
        nonlocal cur, query, exact
        query = _both(query, _least({_trigrams(s) for s in cur}))
        cur, exact = {""}, False

    for op, arg in items:
        strings, inner = None, _ALWAYS
        if op == sre.LITERAL:
            strings = {chr(arg).lower()}
        elif op == sre.IN and all(o == sre.LITERAL for o, _ in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif op == sre.SUBPATTERN:
            strings, inner = _walk(arg[-1])
        elif op == sre.BRANCH:
            parts = [_walk(b) for b in arg[1]]
            inner = _least({x for _, q in parts for x in q})
            if all(s is not None for s, _ in parts):
                strings = {x for s, _ in parts for x in s}
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            s, q = _walk(body)
            if high == 1 and s is not None:
                strings = s | {""} if low == 0 else s
            elif low == high and s is not None and len(s) ** low <= MAX_STRINGS:
                strings = {""}
                for _ in range(low):
                    strings = {x + y for x in strings for y in s}
            elif low > 0:
                inner = q
        if strings is not None and len(cur) * len(strings) <= MAX_STRINGS:
            cur = {x + y for x in cur for y in strings}
        else:
            flush()
            if strings is not None:
                inner = _least({_trigrams(s) for s in strings})
            query = _both(query, inner)
    if exact:
        return cur, _least({_trigrams(s) for s in cur})
    flush()
    return None, query


def trigram_query(regex: str) -> set[frozenset[str]]:
    """Trigram sets of which any match contains (lower-cased) at least one in
    full; ``{frozenset()}`` if nothing is mandatory."""
    return _walk(sre_parse.parse(regex))[1]


def _spans(text: Column, rule: Rule, kind_no: int) -> Column:
    """Array of (start, kind_no, end) of a rule's matches in ``text``."""
    pattern = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, rule.regex, -1), lambda g: F.length(g).cast("long"))
    kind = "array<struct<start:long,kind:int,end:long>>"
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    found = F.aggregate(
        F.filter(pairs, lambda p: p["m"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + F.length(p["m"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + p["gap"]).alias("start"), F.lit(kind_no).alias("kind"),
                (acc["at"] + p["gap"] + F.length(p["m"])).alias("end"))).cast(kind)
                if not rule.min_value else
                F.filter(F.array(F.struct(
                    (acc["at"] + p["gap"]).alias("start"), F.lit(kind_no).alias("kind"),
                    (acc["at"] + p["gap"] + F.length(p["m"])).alias("end"))).cast(kind),
                    lambda _: F.length(F.regexp_extract(p["m"], rule.regex, rule.value_group)) >= rule.min_value)
            ).alias("out")),
        lambda acc: acc["out"])
    return found


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(doc_id, text_hash, rules)`` of texts that some indexed rule must
    search; ``texts`` has ``doc_id``, ``text``, ``text_hash``."""
    spark = texts.sparkSession
    terms = [(r.kind, i, t, len(term)) for r in rules
             for i, term in enumerate(sorted(map(sorted, trigram_query(r.regex)))) for t in term if t]
    wanted = sorted({t for _, _, t, _ in terms})
    low = F.lower("text")
    present = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted)))
    postings = texts.select("doc_id", "text_hash", F.explode(present).alias("trigram"))
    table = spark.createDataFrame(terms, "kind string, term int, trigram string, need int")
    # the terms' number is fixed by the rules
    met = (postings.join(F.broadcast(table), "trigram")
           .groupBy("doc_id", "text_hash", "kind", "term", "need").agg(F.count_distinct("trigram").alias("n"))
           .where("n = need"))
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set("kind").alias("rules"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_assign``,
    ``n_access``, ``n_hex`` (a column for each base rule), ``base_sha256`` of
    the base spans and ``spans``, those of all rules, as ``kind:start:end`` in
    code points joined by commas, by start, then kind in the rules' order. A
    null text is empty; null ``doc_id`` values and repeated rows are kept; an
    empty table gives an empty result."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    found = candidates(texts, rules).withColumnsRenamed({"doc_id": "c_id", "text_hash": "c_hash"})
    joined = texts.join(found, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left")
    empty = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    per_rule = {}
    for i, r in enumerate(rules):
        spans = _spans(F.col("text"), r, i)
        full = trigram_query(r.regex) == _ALWAYS
        per_rule[r.kind] = spans if full else F.when(F.array_contains("rules", r.kind), spans).otherwise(empty)
    out = joined.select("doc_id", *(c.alias(f"at_{k}") for k, c in per_rule.items()))
    names = F.array(*(F.lit(r.kind) for r in rules))

    def joined_text(kinds: list[str]) -> Column:
        every = F.array_sort(F.concat(*(F.col(f"at_{k}") for k in kinds)))
        return F.array_join(F.transform(every, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [r.kind for r in rules if r.base]
    return out.select("doc_id", *(F.size(f"at_{k}").cast("long").alias(f"n_{k}") for k in base),
                      F.sha2(joined_text(base).cast("binary"), 256).alias("base_sha256"),
                      joined_text([r.kind for r in rules]).alias("spans"))


def scan_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB SQL, every rule searching every text."""
    parts, kinds = [], [r.kind for r in rules]
    for i, r in enumerate(rules):
        pat = r.regex.replace("'", "''")
        keep = (f"len(regexp_extract(s.m, '{pat}', {r.value_group})) >= {r.min_value}" if r.min_value else "true")
        parts.append(f"""
  select rid, {i} as kind, '{r.kind}' as name, s.pos as pos, s.pos + len(s.m) as upto from (
    select rid, unnest(list_transform(range(len(m)), lambda i: {{
      'm': m[i + 1],
      'pos': cast(coalesce(list_sum(list_transform(g[1:i + 1], lambda x: len(x))), 0)
            + coalesce(list_sum(list_transform(m[1:i], lambda x: len(x))), 0) as bigint)}})) as s
    from (select rid, regexp_extract_all(text, '{pat}') as m, string_split_regex(text, '{pat}') as g from d)
    where len(m) > 0) where {keep}""")
    base = [i for i, r in enumerate(rules) if r.base]
    word = "name || ':' || pos || ':' || upto"
    base_list = ", ".join(map(str, base))
    return f"""
with d as materialized (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
s as ({' union all '.join(parts)}),
a as (select rid, {', '.join(f"count(*) filter (kind = {i}) as n_{kinds[i]}" for i in base)},
  coalesce(string_agg({word}, ',' order by pos, kind) filter (kind in ({base_list})), '') as b,
  string_agg({word}, ',' order by pos, kind) as spans from s group by rid)
select doc_id, {', '.join(f"coalesce(n_{kinds[i]}, 0) as n_{kinds[i]}" for i in base)},
  sha256(coalesce(b, '')) as base_sha256, coalesce(spans, '') as spans
from d left join a using (rid)"""
