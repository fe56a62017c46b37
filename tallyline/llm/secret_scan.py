"""Secret scan: fixed patterns label credentials, automata inferred from them score every other candidate.

The patterns give base spans, which always stay. Their values are the labelled credentials. From a bounded sample of
the distinct ones a probabilistic prefix tree over character classes is built for each kind, and states whose
outgoing frequencies agree within Hoeffding's bound are merged, from the root on, into an automaton. Every run of
token characters outside the base spans that is long enough and mixes letters and digits is a candidate; the
automaton that likes it best gives its format likelihood, the mean log-probability of a character. A candidate as
likely as nearly all labelled credentials of that kind, and more likely than one drawn at random, is a span of kind
`format`.

Defined results: a missing text counts as empty and has no span. Without labelled credentials nothing is added. Rows
are scanned one by one, whatever their ids. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of
from tallyline.llm.words import pieces

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# Runs are maximal, so asking for the length at once finds the same spans as dropping the short ones afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST_VALUE, LEAST_DIGITS, LEAST_LETTERS = 6, 2, 2
#: Labelled values to learn from, for each kind; none longer than LONGEST is used for learning.
VALUES_PER_KIND, LONGEST = 400, 256
#: Confidence of the merge test, and the part of the labelled values that must reach the threshold.
ALPHA, RECALL = 0.05, 0.95
CLASSES = [("0123456789", 10), ("abcdef", 6), ("ghijklmnopqrstuvwxyz", 20), ("ABCDEF", 6), ("GHIJKLMNOPQRSTUVWXYZ", 20), *((c, 1) for c in "+/_.=-")]
CLASS_OF = {c: k for k, (letters, _) in enumerate(CLASSES) for c in letters}
SIZE_OF = [size for _, size in CLASSES]
SPANS_SQL = "array<struct<kind:int,first:bigint,last:bigint,value:string>>"
SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("value", pa.string())]))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) by start, then kind."""
    out = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    out += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Runs of token characters that mix letters and digits and touch no base span."""
    out = []
    # The base spans as disjoint stretches in order.
    firsts, lasts = [], []
    for _, first, last, _ in taken:
        if lasts and first <= lasts[-1]:
            lasts[-1] = max(lasts[-1], last)
        else:
            firsts.append(first)
            lasts.append(last)
    for m in CANDIDATE.finditer(text):
        digits, letters = sum(c.isdigit() for c in m[0]), sum(c.isalpha() for c in m[0])
        before = bisect_left(firsts, m.end()) - 1
        if digits >= LEAST_DIGITS and letters >= LEAST_LETTERS and (before < 0 or lasts[before] <= m.start()):
            out.append((3, m.start(), m.end(), m[0]))
    return out


class Automaton:
    """States with counts: how many strings pass, how many end, and for each class the next state and how many take it."""

    def __init__(self, values: list[str]):
        self.passed, self.ended, self.next = [0], [0], [{}]
        for value in sorted(values):
            self._insert([CLASS_OF[c] for c in value])
        self._merge()
        self.scores = sorted(self.score(v) for v in values)
        self.cut = self.scores[int((1 - RECALL) * len(values))] - 1e-9

    def _insert(self, symbols: list[int]) -> None:
        at = 0
        for symbol in symbols:
            self.passed[at] += 1
            if symbol not in self.next[at]:
                self.next[at][symbol] = [len(self.next), 0]
                self.passed.append(0)
                self.ended.append(0)
                self.next.append({})
            step = self.next[at][symbol]
            step[1] += 1
            at = step[0]
        self.passed[at] += 1
        self.ended[at] += 1

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passed[a], self.passed[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for symbol in self.next[a].keys() | self.next[b].keys():
                left, right = self.next[a].get(symbol), self.next[b].get(symbol)
                if abs((left[1] if left else 0) / n - (right[1] if right else 0) / m) > bound:
                    return False
                if left and right:
                    todo.append((left[0], right[0]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the counts of a subtree to the states it falls on."""
        todo = [(into, tree)]
        while todo:
            into, tree = todo.pop()
            self.passed[into] += self.passed[tree]
            self.ended[into] += self.ended[tree]
            for symbol, (child, count) in list(self.next[tree].items()):
                if symbol in self.next[into]:
                    self.next[into][symbol][1] += count
                    todo.append((self.next[into][symbol][0], child))
                else:
                    self.next[into][symbol] = [child, count]

    def _merge(self) -> None:
        kept = [0]
        while True:
            known = set(kept)
            open_ = [(r, s) for r in kept for s, (child, _) in sorted(self.next[r].items()) if child not in known]
            if not open_:
                return
            # The state most strings pass is settled first.
            parent, symbol = max(open_, key=lambda x: (self.next[x[0]][x[1]][1], -x[0], -x[1]))
            state = self.next[parent][symbol][0]
            for other in kept:
                if self._alike(other, state):
                    self.next[parent][symbol][0] = other
                    self._fold(other, state)
                    break
            else:
                kept.append(state)

    def score(self, value: str) -> float:
        """Mean log-probability of a character, the end included."""
        at, total = 0, 0.0
        for c in value:
            symbol = CLASS_OF[c]
            step = self.next[at].get(symbol)
            total += math.log(((step[1] if step else 0) + 0.02) / (self.passed[at] + 0.02 * (len(CLASSES) + 1))) - math.log(SIZE_OF[symbol])
            at = step[0] if step else 0
        return (total + math.log((self.ended[at] + 0.02) / (self.passed[at] + 0.02 * (len(CLASSES) + 1)))) / (len(value) + 1)


def accepted(value: str, automata: list[Automaton]) -> bool:
    """Whether some automaton finds the value as likely as its own credentials, and likelier than a random one."""
    return any(a.score(value) >= max(a.cut, -math.log(len(CLASS_OF))) for a in automata)


def _spans(rows) -> pa.Array:
    return pa.array([[dict(zip(("kind", "first", "last", "value"), s, strict=True)) for s in row] for row in rows], SPAN)


def found_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """Base spans and candidates of a text."""
    base = base_spans(text or "")
    return base + candidates(text or "", base)


def labelled(texts: DataFrame, values_per_kind: int = VALUES_PER_KIND) -> list[tuple[int, str]]:
    """(kind, value) of distinct labelled credentials in `text`: of each kind those whose hashes are lowest.

    Values are hashed, cut and counted in the tasks and never written as a table.
    """

    @F.arrow_udf("array<struct<kind:int,value:string>>")
    def values(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))
        out = [pa.array([], kind)]
        for piece in pieces(texts):
            out.append(pa.array([[{"kind": k, "value": v} for k, v in sorted({(k, v) for k, _, _, v in base_spans(t or "") if len(v) <= LONGEST})] for t in piece.to_pylist()], kind))
        return pa.concat_arrays(out)

    found = texts.select(F.explode(values(F.col("text"))).alias("s")).select("s.kind", "s.value").distinct()
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("value", F.lit("labelled")), "value"))
    drawn = found.withColumn("rank", rank).filter(F.col("rank") <= values_per_kind)
    return sorted((r["kind"], r["value"]) for r in drawn.collect())


def learned(drawn: list[tuple[int, str]]) -> list[Automaton]:
    """One automaton for each kind of labelled credentials."""
    return [Automaton([v for kind, v in drawn if kind == k]) for k in range(3) if any(kind == k for kind, _ in drawn)]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the array `spans` (kind, first, last, value) of every row: base spans and accepted candidates.

    The texts are read twice, to learn and to judge: no value of a secret is written in between.
    """
    texts = columns_of(docs, doc_id="bigint", text="string")
    sent = docs.sparkSession.sparkContext.broadcast([vars(a) for a in learned(labelled(texts))])

    @F.arrow_udf(SPANS_SQL)
    def judged(texts: pa.Array) -> pa.Array:
        automata = []
        for state in sent.value:
            automata.append(Automaton.__new__(Automaton))
            automata[-1].__dict__.update(state)
        out = [pa.array([], SPAN)]
        for piece in pieces(texts):
            kept = ([s for s in found_spans(text) if s[0] < 3 or accepted(s[3], automata)] for text in piece.to_pylist())
            out.append(_spans([sorted(row, key=lambda s: (s[1], s[0])) for row in kept]))
        return pa.concat_arrays(out)

    return texts.select("doc_id", judged(F.col("text")).alias("spans"))


def digest(spans: Column, base_only: bool) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind"] < 3) if base_only else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"].cast("string"), s["last"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
