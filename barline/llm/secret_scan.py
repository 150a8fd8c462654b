"""Secret scan over a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: a match cannot
be there unless the query holds. Posting lists say which rows hold which of these
trigrams; the queries intersect and unite lists, and only the rows that are left
are searched with the pattern itself. Rules in which no trigram is mandatory are
searched in every row. All of it is DataFrame functions; only the patterns, which
are parameters, are taken apart on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.common import join_few, row_key
from barline.sources.tables import stage

#: A disjunction of sets of trigrams that must occur together; an empty set asks for nothing.
Query = list[frozenset[str]]
ANY: Query = [frozenset()]


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Python's parser and Java. A match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The kinds that are counted and digested, in their order.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
]
# Public token formats that the method adds.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
]


def trigram_query(pattern: str) -> Query:
    """What lower-cased trigrams a text must hold for the pattern to match."""
    exact, query = _derive(parser.parse(pattern))
    return query if exact is None else _both(query, _of_strings(exact))


def _derive(nodes) -> tuple[set[str] | None, Query]:
    """All strings a sequence can match (None: too many), and what must be there besides."""
    exact, query, broken = {""}, ANY, False
    for kind, arg in nodes:
        part, asked = _derive_one(kind, arg)
        if part is not None and len(exact) * len(part) <= 16:
            exact = {a + b for a in exact for b in part}
            continue
        query = _both(_both(query, _of_strings(exact)), asked)
        if part is not None:
            exact = part
        else:
            exact, broken = {""}, True
    if not broken and query == ANY:
        return exact, ANY
    return None, _both(query, _of_strings(exact))


def _derive_one(kind, arg) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(arg).lower()}, ANY
    if kind is op.SUBPATTERN:
        return _derive(arg[-1])
    if kind is op.BRANCH:
        parts = [_derive(x) for x in arg[1]]
        if all(p is not None for p, _ in parts):
            return set().union(*(p for p, _ in parts)), ANY
        return None, [c for p, q in parts for c in (_of_strings(p) if p is not None else q)]
    if kind is op.IN and all(k is op.LITERAL for k, _ in arg) and len(arg) <= 16:
        return {chr(x).lower() for _, x in arg}, ANY
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = arg
        part, asked = _derive(inner)
        if (low, high) == (0, 1) and part is not None:
            return part | {""}, ANY
        if low:
            return None, asked if part is None else _of_strings(part)
        return None, ANY
    return (None, ANY) if kind is not op.AT else ({""}, ANY)


def _of_strings(strings: set[str]) -> Query:
    grams = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return ANY if not all(grams) else sorted(set(grams), key=sorted)


def _both(a: Query, b: Query) -> Query:
    joint = sorted({x | y for x in a for y in b}, key=sorted)
    return joint if len(joint) <= 64 else a  # one of the two is a weaker query, and enough


def scan(
    docs: DataFrame,
    rules: list[Rule],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_block: int = 1 << 14,
) -> DataFrame:
    """The secrets of each row: ``doc_id`` and ``spans``, an array of (``start``, ``nth``, ``end``, ``kind``).

    Matches of a rule are leftmost and do not overlap. ``start`` and ``end`` count
    code points, ``end`` is exclusive; spans are ordered by start, then by rule
    (``nth``). NULL texts are empty and, like texts without a match, get an empty
    array. Repeated rows, and rows with NULL or repeated ids, are each scanned by
    their own text. An empty table gives no rows. Columns besides the two named are
    not read. Posting lists are cut into blocks of about ``rows_per_block`` rows.
    """
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    searched = [r for r in rules if frozenset() not in asked[r.kind]]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "key", row_key("doc_id", "text")
    )
    found = rows
    if searched:
        candidates = stage(_candidates(rows, {r.kind: asked[r.kind] for r in searched}, rows_per_block), "secret-candidates")
        some = join_few(rows, candidates, "key")
        # Rows that share a key by chance are told apart by their texts' digests.
        indexed = some.select("key", F.sha2("text", 256).alias("sha"), *[
            F.when(F.array_contains("kinds", r.kind), _spans(r, rules.index(r))).otherwise(_none()).alias(r.kind) for r in searched
        ])
        hits = indexed.select("key", "sha", F.flatten(F.array(*[F.col(r.kind) for r in searched])).alias("indexed"))
        hits = hits.filter(F.size("indexed") > 0).dropDuplicates(["key", "sha"])
    scanned = [_spans(r, rules.index(r)) for r in rules if r not in searched]
    found = rows.select("doc_id", "key", F.sha2("text", 256).alias("sha"), (F.flatten(F.array(*scanned)) if scanned else _none()).alias("scanned"))
    if searched:
        found = found.join(hits, ["key", "sha"], "left")
    indexed = F.coalesce("indexed", _none()) if searched else _none()
    return found.select("doc_id", F.array_sort(F.concat("scanned", indexed)).alias("spans"))


def _candidates(rows: DataFrame, queries: dict[str, Query], rows_per_block: int) -> DataFrame:
    """``key`` and ``kinds``: the rows that satisfy each rule's query, by its posting lists."""
    grams = sorted({g for q in queries.values() for clause in q for g in clause})
    blocks = max(1, rows.select(F.lit(1)).count() // rows_per_block)
    # `transform` over one element binds the lower-cased text, which is computed once.
    held = F.transform(F.array(F.lower("text")), lambda t: F.filter(F.array(*map(F.lit, grams)), lambda g: F.contains(t, g)))[0]
    entries = rows.select("key", F.pmod("key", F.lit(blocks)).alias("block"), F.explode(held).alias("gram"))
    lists = entries.groupBy("block", "gram").agg(F.collect_set("key").alias("keys"))
    index = lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def clause(needs: frozenset[str]) -> Column:
        return reduce(F.array_intersect, [F.coalesce(F.element_at("lists", F.lit(g)), none) for g in sorted(needs)])

    per_rule = [
        F.struct(F.lit(kind).alias("kind"), reduce(F.array_union, [clause(c) for c in query]).alias("keys"))
        for kind, query in queries.items()
    ]
    listed = index.select(F.explode(F.array(*per_rule)).alias("rule"))
    return (
        listed.select("rule.kind", F.explode("rule.keys").alias("key"))
        .groupBy("key").agg(F.collect_set("kind").alias("kinds"))
    )


def _none() -> Column:
    return F.array().cast("array<struct<start:int,nth:int,end:int,kind:string>>")


def _spans(rule: Rule, nth: int) -> Column:
    """A rule's matches in ``text``. What lies between matches tells where they are."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    kept = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else hits
    between = F.split("text", rule.pattern, -1)

    def add(sofar: Column, hit: Column) -> Column:
        start = sofar["at"] + F.length(hit["between"])
        end = start + F.length(hit["hit"])
        span = F.struct(start.alias("start"), F.lit(nth).alias("nth"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        spans = F.when(F.length(hit["kept"]) >= rule.least, F.concat(sofar["spans"], F.array(span))).otherwise(sofar["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    zipped = F.arrays_zip(between.alias("between"), hits.alias("hit"), kept.alias("kept"))
    matched = F.filter(zipped, lambda z: z["hit"].isNotNull())
    walked = F.aggregate(matched, F.struct(F.lit(0).alias("at"), _none().alias("spans")), add, lambda s: s["spans"])
    return F.when(F.col("text").rlike(rule.pattern), walked).otherwise(_none())
