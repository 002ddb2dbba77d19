"""Secret scans over a trigram inverted index, with DataFrame functions only.

Each rule's expression is read into a Boolean query over the trigrams that any match must hold. The
index has, for each such trigram, the rows whose lower-cased text holds it; postings are intersected
and united per rule as its query says, and only the candidates are verified with the expression. Rules
without a mandatory trigram are verified on all rows. Only trigrams that some rule asks for are indexed.

Defined cases: a null or empty text has no spans; a null key is kept; rows are told apart by key and text,
so repeated rows or keys each get their own result; long texts are scanned whole, in time that grows as they
do; a column of the table that has the name `found` gives way to the result; no other name clashes, as all
other columns travel in one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import passed, quoted

try:  # the parser of expressions is private under either name
    from re import _constants as rc
    from re import _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as rc
    import sre_parse as parser

#: Sets of strings larger than this are not followed further.
MOST_STRINGS = 24


@dataclass(frozen=True)
class Rule:
    """An expression; matches are leftmost and don't overlap, and those that fail the lengths are dropped."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 1

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


#: The three rules whose spans are the base of every result.
# Fixed values
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 20),
    Rule("hex", r"[0-9a-f]+", False, 0, 24),
)
#: Further rules, whose spans are added. Runs start at a boundary and are possessive, so that no text takes quadratic time.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay", r"[sr]k_(live|test)_[0-9A-Za-z]{16,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", True),
    Rule("url", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\s/:@]++:[^\s/:@]++@", True),
)
RULES = BASE + MORE

# A query is True (all rows), or ("and" | "or", parts), or a trigram.


def _join(kind: str, parts: list) -> object:
    flat: list = []
    for p in parts:
        flat += list(p[1]) if isinstance(p, tuple) and p[0] == kind else [p]
    if kind == "and":
        flat = [p for p in flat if p is not True]
        if not flat:
            return True
    elif True in flat:
        return True
    flat = list(dict.fromkeys(flat))
    if kind == "or":  # what asks for more than another part adds nothing
        need = [frozenset(p[1]) if isinstance(p, tuple) and p[0] == "and" and all(isinstance(x, str) for x in p[1]) else frozenset([p]) for p in flat]
        flat = [p for p, n in zip(flat, need, strict=True) if not any(m < n for m in need)]
    return flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _of_strings(strings: frozenset[str]) -> object:
    """Any of these strings, by their trigrams; a string under three characters asks for nothing."""
    if not strings or min(map(len, strings)) < 3:
        return True
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _parse(tree) -> tuple[frozenset[str] | None, object]:
    """(all strings that it can match, or None; what any match of it must hold) for a sequence."""
    run: frozenset[str] | None = frozenset([""])
    whole, must = True, []

    def cut() -> None:
        nonlocal run, whole
        if run is not None and run != frozenset([""]):
            must.append(_of_strings(run))
        run, whole = frozenset([""]), False

    for op, arg in tree:
        strings, query = _one(op, arg)
        if strings is None:
            cut()
            must.append(query)
            continue
        longer = frozenset(a + b for a, b in product(run, strings))
        if len(longer) > MOST_STRINGS:
            cut()
            longer = strings
        run = longer
    if whole:
        return run, _of_strings(run)
    cut()
    return None, _join("and", must)


def _one(op, arg) -> tuple[frozenset[str] | None, object]:
    if op is rc.LITERAL:
        return frozenset([chr(arg).lower()]), True
    if op is rc.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is rc.LITERAL:
                chars.add(chr(value).lower())
            elif kind is rc.RANGE and value[1] - value[0] < 8:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, True
        return (frozenset(chars), True) if len(chars) <= 8 else (None, True)
    if op is rc.SUBPATTERN:
        return _parse(arg[-1])
    if op is rc.BRANCH:
        parts = [_parse(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            strings = frozenset().union(*(s for s, _ in parts))
            if len(strings) <= MOST_STRINGS:
                return strings, _of_strings(strings)
        return None, _join("or", [q if s is None else _of_strings(s) for s, q in parts])
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _parse(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, True
        if low == high == 1:
            return strings, query
        return None, query if low and strings is None else _of_strings(strings) if low else True
    if op is rc.AT:
        return frozenset([""]), True
    return None, True


def trigram_query(pattern: str) -> object:
    """The Boolean query over lower-case trigrams that any match of the expression satisfies."""
    strings, query = _parse(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def _trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(_trigrams(q) for q in query[1]))


def _holds(query: object, have: Column, number: dict[str, int]) -> Column:
    """Whether a set of trigram numbers, as a bit mask in longs, satisfies the query."""
    if isinstance(query, str):
        n = number[query]
        return have[n // 63].bitwiseAND(F.lit(1 << n % 63)) != 0
    parts = [_holds(q, have, number) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if query[0] == "and" else (out | p)
    return out


def postings(docs: DataFrame, trigrams: list[str], key: str, text: str) -> DataFrame:
    """The inverted index (trigram number, key): a row for each trigram that a text holds."""
    low = docs.select(F.col(quoted(key)).alias("key"), F.lower(F.col(quoted(text))).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return low.select("key", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, object], trigrams: list[str]) -> DataFrame:
    """Intersects and unites postings by the rules' queries: key and rules, the numbers of those it may match."""
    number = {t: i for i, t in enumerate(trigrams)}
    words = [F.bit_or(F.when((F.col("trigram") >= w) & (F.col("trigram") < w + 63), F.expr(f"shiftleft(1L, trigram - {w})")).otherwise(F.lit(0).cast("long"))).alias(f"w{w // 63}") for w in range(0, max(1, len(trigrams)), 63)]
    merged = index.groupBy("key").agg(*words)
    have = F.array(*[F.col(f"w{w // 63}") for w in range(0, max(1, len(trigrams)), 63)])
    mask = F.lit(0).cast("long")
    for i, (_, q) in enumerate(queries.items()):
        mask = mask.bitwiseOR(F.when(_holds(q, have, number), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return merged.select("key", mask.alias("rules")).where("rules != 0")


def _bounded(rule: Rule) -> str:
    """A class repeated after a fixed word finds the same long runs with a lower bound, and passes by the short ones."""
    head, _, last = rule.pattern.rpartition("[")
    if rule.group == 0 and rule.least > 1 and last.endswith("]+") and re.fullmatch(r"[A-Za-z0-9_]*", head):
        return f"{rule.java[:-1]}{{{max(1, rule.least - len(head))},}}"
    return rule.java


_FOUND = "array<struct<start:int,kind:int,end:int>>"
#: Matches that are put together before they are added to the others, so that long lists aren't copied for each match.
_CHUNK = 64


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a name in a lambda isn't inlined, as a column would be."""
    return F.transform(F.array(value), body)[0]


def _chunked(items: Column, kind: str, first: Column, step, add) -> Column:
    """Goes through an array with a state {at, ...}, and gathers what `add(state, item)` gives (an array) in order.

    step(state, item) is the state after an item. The result is the struct<state, out>.
    """
    none = F.array().cast(kind)
    last = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
    inner = lambda s, x: F.struct(step(s["state"], x).alias("state"), F.concat(s["out"], add(s["state"], x)).alias("out"))
    chunk = lambda s, c: F.aggregate(F.slice(items, c * _CHUNK + 1, _CHUNK), F.struct(s["state"].alias("state"), none.alias("out")), inner)
    outer = lambda s, c: _let(chunk(s, c), lambda got: F.struct(got["state"].alias("state"), F.concat(s["out"], F.array(got["out"])).alias("out")))
    start = F.struct(first.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(last, start, outer, lambda s: F.struct(s["state"].alias("state"), F.flatten(s["out"]).alias("out")))


def _found(rule: Rule, order: int, text: Column) -> Column:
    """A rule's kept matches in a text; what lies between matches gives their places, in code points."""
    pattern, empty = _bounded(rule), F.array().cast(_FOUND)
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    parts = F.regexp_extract_all(text, F.lit(pattern), rule.group) if rule.group else whole
    lengths = F.transform(F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap"), whole.alias("whole"), parts.alias("part")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("whole"), (F.length(x["part"]) >= rule.least).alias("kept")))
    step = lambda s, x: F.struct((s["at"] + x["gap"] + x["whole"]).alias("at"))
    one = lambda s, x: F.struct((s["at"] + x["gap"]).alias("start"), F.lit(order).alias("kind"), (s["at"] + x["gap"] + x["whole"]).alias("end"))
    add = lambda s, x: F.when(x["kept"], F.array(one(s, x))).otherwise(empty)
    return F.when(text.rlike(pattern), _let(lengths, lambda items: _chunked(items, _FOUND, F.struct(F.lit(0).alias("at")), step, add)["out"])).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs' columns and found: array<struct<start, kind, end>> of all rules in order of start, then rule."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}
    empty = F.array().cast(_FOUND)
    own = passed(docs.columns, ("found",))
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in own]).alias("own"), F.struct(F.col(quoted(key)).alias("k"), F.xxhash64(whole).alias("h")).alias("key"), whole.alias("text"))
    if indexed:
        trigrams = sorted(set().union(*(_trigrams(q) for q in indexed.values())))
        sure = candidates(postings(rows, trigrams, "key", "text"), indexed, trigrams)
        rows = rows.join(sure, "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(0).cast("long"))
    place = {k: i for i, k in enumerate(indexed)}
    parts = []
    for order, rule in enumerate(rules):
        found = _found(rule, order, F.col("text"))
        if rule.kind in place:
            found = F.when(F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(F.lit(1 << place[rule.kind])) != 0, found).otherwise(empty)
        parts.append(found)
    return rows.select(*[F.col(f"own.{quoted(c)}") for c in own], F.array_sort(F.concat(*parts)).alias("found"))


def spelt(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of spans, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", kinds[x["kind"]], x["start"], x["end"])), ",")


def redact(rows: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """rows with found -> the same without it, spans of the text replaced by [SECRET:kind], overlapping ones as one.

    The text that is left gets shorter as spans are met, and spans are taken in chunks, so the time grows as the text does.
    """
    kinds, value = F.array(*[F.lit(r.kind) for r in rules]), F.col(quoted(text))
    # where each span begins and ends after those before it: one that begins inside another adds no mark
    reach = _chunked(F.col("found"), "array<struct<start:int,kind:int,end:int>>", F.struct(F.lit(0).alias("at")), lambda s, x: F.struct(F.greatest(s["at"], x["end"]).alias("at")), lambda s, x: F.array(F.struct(F.when(x["start"] < s["at"], F.lit(-1)).otherwise(x["start"]).alias("start"), x["kind"].alias("kind"), F.greatest(s["at"], x["end"]).alias("end"))))["out"]
    last = F.when(F.size("found") > 0, F.sequence(F.lit(0), F.floor((F.size("found") - 1) / _CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))

    def chunk(s: Column, spans: Column) -> Column:
        """The state after some spans: `left` is the text from `at` on."""
        end = F.element_at(spans, -1)["end"]

        within = F.substring(s["left"], F.lit(1), end - s["at"])
        near = F.struct(within.alias("left"), s["at"].alias("at"))
        put = lambda n: F.aggregate(spans, F.struct(s["at"].alias("at"), F.array().cast("array<string>").alias("out")), lambda t, x: one_of(n, t, x))

        def one_of(n: Column, t: Column, x: Column) -> Column:
            gap = F.substring(n["left"], t["at"] - n["at"] + 1, x["start"] - t["at"])
            return F.when(x["start"] < 0, F.struct(x["end"].alias("at"), t["out"].alias("out"))).otherwise(F.struct(x["end"].alias("at"), F.concat(t["out"], F.array(gap, F.concat(F.lit("[SECRET:"), kinds[x["kind"]], F.lit("]")))).alias("out")))

        pieces = _let(near, lambda n: put(n)["out"])
        return F.struct(F.substring(s["left"], end - s["at"] + 1, F.lit(2**31 - 1)).alias("left"), end.alias("at"), F.concat(s["out"], F.array(F.array_join(pieces, ""))).alias("out"))

    start = F.struct(value.alias("left"), F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = _let(reach, lambda spans: F.aggregate(last, start, lambda s, c: _let(F.slice(spans, c * _CHUNK + 1, _CHUNK), lambda own: chunk(s, own)), lambda s: F.concat(F.array_join(s["out"], ""), s["left"])))
    return rows.withColumn(text, F.when(F.size("found") > 0, done).otherwise(value)).drop("found")
