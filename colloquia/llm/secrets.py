"""Secret scans through a trigram inverted index (native).

Each rule's pattern is analysed once on the driver into a Boolean trigram query in
disjunctive form. The index holds a posting (trigram, document) for every trigram that any
query names; intersecting postings gives the candidate rules of each document, and only
candidates are matched by the rule itself. Rules without a mandatory trigram scan every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

MAX_STRINGS = 64


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` has no capturing group, or its group 1 is the secret of ``min_chars`` or more."""

    kind: str
    pattern: str
    min_chars: int = 0
    base: bool = False


#: Kinds and patterns of the base rules, in their listed order.
BASE_RULES = (
    SecretRule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, True),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", 0, True),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, True),
)
#: Further rules of well-known token formats.
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("hosting", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def _strings(items) -> tuple[list[set[str]], set[str] | None]:
    """Of a parsed sequence: string sets of which each must hold one member, and the exact set.

    The exact set is None when the sequence isn't a small finite language.
    """
    needs: list[set[str]] = []
    run: set[str] = {""}
    exact = True

    def close():
        nonlocal run
        if run != {""}:
            needs.append(run)
        run = {""}

    def join(more: set[str]):
        nonlocal run, exact
        grown = {a + b for a in run for b in more}
        if len(grown) > MAX_STRINGS:
            close()
            exact = False
            grown = more
        run = grown

    for op, arg in items:
        if op is C.LITERAL:
            join({chr(arg).lower()})
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            join({chr(a).lower() for _, a in arg})
        elif op is C.SUBPATTERN:
            inner, whole = _strings(arg[3])
            if whole is None:
                close()
                exact = False
                needs += inner
            else:
                join(whole)
        elif op is C.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            if all(w is not None for _, w in parts):
                join(set().union(*(w for _, w in parts)))
            else:
                close()
                exact = False
        elif op is C.MAX_REPEAT and arg[:2] == (0, 1) and (whole := _strings(arg[2])[1]) is not None:
            join(whole | {""})
        elif op is C.MAX_REPEAT:
            low, high, inner_items = arg
            inner, whole = _strings(inner_items)
            close()
            exact = False
            if low:
                needs += inner if whole is None else [whole]
        elif op is not C.AT:
            close()
            exact = False
    if exact:
        return [run], run
    close()
    return needs, None


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Disjunction of trigram sets, one of which every match holds in lower case; [] if none is mandatory."""
    best: list[frozenset[str]] = []
    for strings in _strings(P.parse(pattern))[0]:
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        if all(sets) and (not best or min(map(len, sets)) > min(map(len, best))):
            best = sorted(set(sets), key=sorted)
    return best


def postings(docs: DataFrame, keys: list[str], text: str, trigrams: list[str]) -> DataFrame:
    """Inverted index (trigram, keys): one posting for each named trigram that a lower-cased text holds."""
    low = docs.select(*keys, F.lower(F.col(text)).alias("t"))
    held = F.array_compact(F.array(*[F.when(F.contains("t", F.lit(g)), F.lit(g)) for g in trigrams]))
    return low.select(*keys, F.explode(held).alias("trigram"))


def candidates(index: DataFrame, keys: list[str], queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(keys, kinds): intersect postings per alternative, unite alternatives per rule.

    Postings are reduced to one row per document before the shuffle; the trigram count is fixed
    by the rules, so a row stays small whatever the text.
    """
    flags = sorted({g for q in queries.values() for s in q for g in s})
    seen = index.groupBy(*keys).agg(*[F.bool_or(F.col("trigram") == g).alias(f"g{i}") for i, g in enumerate(flags)])
    at = {g: F.col(f"g{i}") for i, g in enumerate(flags)}

    def holds(query):
        some = F.lit(False)
        for alternative in query:
            every = F.lit(True)
            for g in sorted(alternative):
                every = every & at[g]
            some = some | every
        return some

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return seen.select(*keys, kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(text: Column, rule: SecretRule) -> Column:
    """array<struct<start, end>> of the rule's leftmost non-overlapping matches that pass, in code points.

    Text between matches comes from splitting by the same pattern, so running lengths of
    pieces and matches give the positions.
    """
    group = 1 if rule.min_chars else 0
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))

    def placed(hits: Column, pieces: Column) -> Column:
        rows = F.transform(hits, lambda m, i: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("len")))
        empty = F.array().cast("array<struct<start:int,end:int>>")

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            end = start + x["len"]
            return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(start.alias("start"), end.alias("end"))).alias("out"))

        spans = F.aggregate(rows, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
        if not rule.min_chars:
            return spans
        secret = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), lambda s: F.length(s))
        return let(secret, lambda n: F.filter(spans, lambda _, i: F.get(n, i) >= rule.min_chars))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return let(found, lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(F.split(text, rule.pattern, -1), lambda pieces: placed(hits, pieces))))


def scan_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, text, ``spans`` array<struct<start, ord, kind, end>> by start, then rule order.

    Null text counts as empty. Postings name a document by id and text hash, so rows that share
    an id, or have none, are told apart and spread. Other columns of the input are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    named = sorted({g for q in queries.values() for s in q for g in s})
    if queries:
        source = source.withColumns({"doc": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "hash": F.xxhash64("text")})
        keys = ["doc", "hash"]
        source = source.join(candidates(postings(source, keys, "text", named), keys, queries).hint("shuffle_hash"), keys, "left")
    else:
        source = source.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def of(order: int, rule: SecretRule) -> Column:
        spans = spans_of(F.col("text"), rule)
        if rule.kind in queries:
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))

    every = F.array_sort(F.concat(*[of(i, r) for i, r in enumerate(rules)]))
    return source.select("doc_id", "text", every.alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
