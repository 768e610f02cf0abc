"""Secret scan with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must hold. The index lists, for the trigrams of all rules,
the documents that contain them; intersecting the postings gives each rule's
candidates and only those are searched. A rule without mandatory trigrams is
searched in every document. All of it is built-in column functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import doc_texts, stored


@dataclass(frozen=True)
class Rule:
    """``pattern`` without look-around; a match counts if its group ``checked`` has ``least`` characters."""
    kind: str
    pattern: str
    groups: int = 0
    checked: int = 0
    least: int = 0


#: In the order in which kinds are listed. The first three are the base rules.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         groups=2, checked=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")

#: A product of alternatives above this is cut short: the query gets weaker, never wrong.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[frozenset[str]]]:
    """What every match of ``pattern`` holds, lower-cased: an AND of clauses, each an OR of sets of trigrams.

    Empty if the pattern has no mandatory trigram.
    """
    clauses: list[frozenset[frozenset[str]]] = []

    def strings(items) -> set[str] | None:
        """All strings that ``items`` can match, or None; adds the clauses of what lies before a gap."""
        runs: set[str] = {""}
        open_ended = False
        for op, arg in items:
            op, grown = str(op), None
            if op == "LITERAL":
                grown = {chr(arg).lower()}
            elif op == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                grown = {chr(a).lower() for _, a in arg}
            elif op == "SUBPATTERN":
                grown = strings(arg[-1])
            elif op == "BRANCH":
                parts = [alternatives(x) for x in arg[1]]
                grown = None if None in parts else set().union(*parts)
            elif op == "MAX_REPEAT" and arg[1] == 1:
                inner = alternatives(arg[2])
                grown = None if inner is None else inner | ({""} if arg[0] == 0 else set())
            elif op == "MAX_REPEAT" and arg[0] == arg[1] <= 8:
                inner = alternatives(arg[2])
                grown = None if inner is None else {"".join(x) for x in product(inner, repeat=arg[0])}
            if grown is not None and len(runs) * len(grown) <= MOST_STRINGS:
                runs = {a + b for a, b in product(runs, grown)}
                continue
            clause(runs)
            runs, open_ended = grown if grown is not None and len(grown) <= MOST_STRINGS else {""}, True
        if open_ended:
            clause(runs)
            return None
        return runs

    def alternatives(items) -> set[str] | None:
        """As ``strings``, for parts that need not be in every match: their clauses don't hold."""
        held = len(clauses)
        found = strings(items)
        del clauses[held:]
        return found

    def clause(runs: set[str]) -> None:
        sets = {frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in runs}
        if frozenset() not in sets:
            clauses.append(frozenset(s for s in sets if not any(o < s for o in sets)))

    whole = strings(regex_parser.parse(pattern))
    if whole is not None:
        clause(whole)
    return clauses


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, doc_id) for each of ``trigrams`` and each document that holds it."""
    wanted = F.array(*map(F.lit, trigrams))
    # the one-element array binds the lower-cased text once for all trigrams
    held = F.transform(F.array(F.lower("text")), lambda t: F.filter(wanted, lambda g: F.contains(t, g)))[0]
    return docs.select("doc_id", F.explode(held).alias("trigram")).select("trigram", "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...], trigrams: list[str]) -> DataFrame:
    """doc_id and, for each rule with mandatory trigrams, whether the document holds them."""
    words = range(0, len(trigrams), 62)
    number = F.array_position(F.array(*map(F.lit, trigrams)), F.col("trigram")) - 1
    bits = index.select("doc_id", number.cast("int").alias("n")).groupBy("doc_id").agg(*[
        F.bit_or(F.when(F.col("n").between(w, w + 61), F.expr(f"shiftleft(1L, n - {w})")).otherwise(F.lit(0).cast("bigint")))
        .alias(f"b{w}") for w in words])

    def holds(grams: frozenset[str]) -> Column:
        masks = {w: sum(1 << (trigrams.index(g) - w) for g in grams if w <= trigrams.index(g) < w + 62) for w in words}
        return reduce(Column.__and__, [F.col(f"b{w}").bitwiseAND(F.lit(m).cast("bigint")) == F.lit(m).cast("bigint") for w, m in masks.items() if m])

    flags = []
    for rule in rules:
        if query := trigram_query(rule.pattern):
            flags.append(reduce(Column.__and__, [reduce(Column.__or__, map(holds, clause)) for clause in query])
                         .alias(f"may_{rule.kind}"))
    return bits.select("doc_id", *flags).where(reduce(Column.__or__, [F.col(f"may_{r.kind}") for r in rules if trigram_query(r.pattern)]))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, end, kind) of a rule's matches, leftmost and non-overlapping, in code points.

    ``\\G`` ties each match to the end of the one before, so the gap before a
    match comes with it and a text is gone through once.
    """
    pattern = F.lit(r"(?s)\G(.*?)(" + rule.pattern + ")")
    parts = [F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))]
    if rule.checked:
        parts.append(F.regexp_extract_all(text, pattern, F.lit(2 + rule.checked)))
    sizes = F.transform(F.arrays_zip(*parts), lambda x: F.struct(
        F.length(x["0"]).alias("gap"), F.length(x["1"]).alias("hit"),
        (F.length(x["2"]) >= rule.least if rule.checked else F.lit(True)).alias("counts")))
    kind = "array<struct<start:int,n:int,end:int,kind:string>>"
    empty = F.array().cast(kind)
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["hit"]).alias("at"),
        F.when(x["counts"], F.concat(acc["found"], F.array(F.struct(
            (acc["at"] + x["gap"]).alias("start"), F.lit(order).alias("n"),
            (acc["at"] + x["gap"] + x["hit"]).alias("end"), F.lit(rule.kind).alias("kind")))))
        .otherwise(acc["found"]).alias("found"))
    return F.aggregate(sizes, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda a: a["found"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and found: the spans of all rules, by start and then in the rules' order.

    Null text counts as empty and gives an empty list, as does a text without
    secrets; repeated rows each get a row, null ids included; an empty table
    gives no rows. Only doc_id and text are looked at.
    """
    docs = doc_texts(docs)
    trigrams = sorted({g for r in rules for c in trigram_query(r.pattern) for s in c for g in s})
    empty = F.array().cast("array<struct<start:int,n:int,end:int,kind:string>>")
    if trigrams:
        index = stored(postings(docs, trigrams), "trigrams")
        may = candidates(index, rules, trigrams).withColumnRenamed("doc_id", "may_id")
        docs = docs.join(may, docs["doc_id"].eqNullSafe(may["may_id"]), "left")
    spans = []
    for n, rule in enumerate(rules):
        allowed = F.coalesce(F.col(f"may_{rule.kind}"), F.lit(False)) if trigram_query(rule.pattern) else F.lit(True)
        spans.append(F.when(allowed & F.col("text").rlike(rule.pattern), rule_spans(F.col("text"), rule, n)).otherwise(empty))
    return docs.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_counts(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base rules' spans, and all spans as text."""
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")
    return scan(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))
