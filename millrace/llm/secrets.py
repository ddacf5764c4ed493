"""Secret scans over a trigram index, in DataFrame functions only.

For each rule a Boolean trigram query is derived from the parse tree of its regular expression:
every run of literal characters gives a clause, an OR over the literal strings it can stand for,
each an AND of that string's trigrams. A rule without such a clause has no mandatory trigram and
scans all texts.

The inverted index holds (trigram, document) postings, in lower case, for the trigrams that the
queries name. Queries intersect and unite postings per document; only documents a rule's query
leaves are verified with the rule's regular expression. Spans are in code points, end exclusive,
leftmost and non-overlapping per rule.

Defined cases: NULL and empty texts hold no secret; a very long text is one row of one task, whose
cost grows with its length and number of matches; rows that repeat a doc_id are scanned by
their own texts; a NULL doc_id is a value like others; an empty table gives no rows. Extra
columns stay; result columns replace those of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as ops
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import BROADCAST_BYTES, row_key

# Strings a run of literals may stand for before it is cut.
_STRINGS = 64
# Matches whose spans are gathered in one array before it is joined to the others.
_CHUNK = 128
# Bytes of a candidate row in a broadcast table, without its doc_id.
_ROW_BYTES = 256
_SPANS = "array<struct<start:bigint,place:int,end:bigint,kind:string,chars:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` must have at least ``chars`` code points, else a match is dropped."""

    kind: str
    regex: str
    group: int = 0
    chars: int = 0


# The first three rules, in this order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # whole runs of hex digits, if long enough
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_hook", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("payment", r"sk_live_[0-9A-Za-z]{16,}"),
)
RULES = BASE + MORE


def _runs(tree) -> list[set[str]]:
    """Literal runs of a sequence: each a set of strings, one of which every match holds."""
    runs: list[set[str]] = []
    now = {""}

    def close():
        nonlocal now
        runs.append(now)
        now = {""}

    for op, arg in tree:
        options: set[str] | None = None
        if op is ops.LITERAL:
            options = {chr(arg)}
        elif op is ops.IN and all(o is ops.LITERAL for o, _ in arg):
            options = {chr(c) for _, c in arg}
        elif op is ops.BRANCH:
            inner = [_runs(b) for b in arg[1]]
            options = set().union(*[r[0] for r in inner]) if all(len(r) == 1 for r in inner) else None
        elif op is ops.SUBPATTERN:
            inner = _runs(arg[-1])
            options = inner[0] if len(inner) == 1 else None
        elif op is ops.MAX_REPEAT and arg[1] == 1:
            inner = _runs(arg[2])
            options = {""} | inner[0] if arg[0] == 0 and len(inner) == 1 else None
        if options is None or len(now) * len(options) > _STRINGS:
            close()
            if options is not None:
                now = options
        else:
            now = {a + b for a, b in product(now, options)}
        if options is None:
            # What the part holds is not used, but a run must not go on across it.
            runs.append({""})
    runs.append(now)
    return runs if len(runs) == 1 else [r for r in runs if r != {""}] + [{""}]


def trigram_query(regex: str) -> tuple[tuple[frozenset[str], ...], ...]:
    """Clauses (AND) of alternatives (OR) of trigrams (AND), lower-case; empty without a mandatory one."""
    clauses = []
    for run in _runs(_parser.parse(regex)):
        strings = {s.lower() for s in run}
        if min(map(len, strings)) >= 3:
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            # An alternative that asks for more than another one adds nothing to the OR.
            clauses.append(tuple(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted)))
    return tuple(clauses)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc, row) for every wanted trigram a text holds."""
    low = F.lower(F.col("text"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return keyed.select("doc", "row", low.alias("low")).select(F.explode(held).alias("trigram"), "doc", "row")


def candidates(index: DataFrame, queries: dict[str, tuple]) -> DataFrame:
    """(doc, row, kinds): the rules whose trigram query a document satisfies."""
    held = index.groupBy("doc", "row").agg(F.collect_set("trigram").alias("held"))

    def satisfied(query) -> Column:
        return _all([_any([_all([F.array_contains("held", t) for t in sorted(a)]) for a in clause]) for clause in query])

    kinds = F.array_compact(F.array(*[F.when(satisfied(q), F.lit(k)) for k, q in queries.items()]))
    return held.select("doc", "row", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def rule_spans(rule: Rule, place: int, text: str = "text") -> Column:
    """All matches of a rule as structs (start, place, end, kind), those too short left out.

    Places are a running sum over the lengths of gaps and matches. Spans are gathered in chunks of
    ``_CHUNK`` matches, so that no array as long as the text's matches is copied for each of them.
    """
    regex = F.lit(rule.regex)
    matches = F.regexp_extract_all(F.col(text), regex, F.lit(0))
    values = F.regexp_extract_all(F.col(text), regex, F.lit(rule.group))
    gaps = F.split(F.col(text), rule.regex, -1)
    found = _bound(matches, lambda m: F.arrays_zip(F.slice(gaps, 1, F.size(m)).alias("gap"), m.alias("match"), values.alias("value")))
    lengths = F.transform(
        found,
        lambda x: F.struct(
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["match"]).cast("long").alias("match"),
            F.length(x["value"]).cast("long").alias("value"),
        ),
    )
    none = F.array().cast(_SPANS)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["match"]
        own = F.struct(
            start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"), x["value"].alias("chars")
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(own)).alias("spans"))

    def chunk_step(state: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, F.struct(state["at"].alias("at"), none.alias("spans")), step)
        return _bound(
            inner, lambda i: F.struct(i["at"].alias("at"), F.concat(state["chunks"], F.array(i["spans"])).alias("chunks"))
        )

    def in_chunks(all_: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(_CHUNK))
        chunks = F.transform(starts, lambda i: F.slice(all_, i, F.lit(_CHUNK)))
        nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPANS}>").alias("chunks"))
        return F.flatten(F.aggregate(chunks, nothing, chunk_step, lambda state: state["chunks"]))

    return F.filter(_bound(lengths, in_chunks), lambda s: s["chars"] >= rule.chars)


def _with_kinds(keyed: DataFrame, left: DataFrame, rows: int, doc_bytes: int, queries: dict[str, tuple]) -> DataFrame:
    """``keyed`` with the kinds whose trigram query a document satisfies; the texts of others never move.

    Counted candidates that fit are broadcast. Beyond that, only texts that hold the trigrams of some
    query are shuffled to meet their candidate row; the rest can have none and stay where they are.
    """
    same = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("row") == F.col("__row"))
    if rows * (doc_bytes + _ROW_BYTES) <= BROADCAST_BYTES or not queries:
        return keyed.join(F.broadcast(left), same, "left")
    low = F.lower(F.col("text"))
    maybe = _any([_all([_any([_all([F.contains(low, F.lit(t)) for t in sorted(a)]) for a in clause]) for clause in q]) for q in queries.values()])
    moved = keyed.where(maybe).join(left, same, "left")
    return moved.unionByName(keyed.where(~maybe), allowMissingColumns=True)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, place, end, kind, chars), by start and order of rules."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for clause in q for alternative in clause for t in alternative})
    names = [c for c in docs.columns if c not in ("text", "secrets")]
    # Extra columns of any name cannot clash inside one struct.
    keyed = docs.select(
        F.col("doc_id").alias("doc"),
        row_key().alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(*names, "text").alias("given"),
    )
    index = materialise(postings(keyed.select("doc", "row", "text"), trigrams), "trigrams")
    found = candidates(index, indexed).select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), "kinds")
    left = materialise(found, "candidates")
    rows, doc_bytes = left.agg(F.count("*"), F.coalesce(F.max(F.octet_length(F.col("__doc").cast("string"))), F.lit(0))).first()
    checked = _with_kinds(keyed, left, rows, doc_bytes, indexed)
    none = F.array().cast(_SPANS)
    spans = []
    for place, rule in enumerate(rules):
        wanted = F.col("text").rlike(rule.regex)
        if rule.kind in indexed:
            wanted = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) & wanted
        spans.append(F.when(wanted, rule_spans(rule, place)).otherwise(none))
    return checked.select("given.*", F.array_sort(F.flatten(F.array(*spans))).alias("secrets"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
