"""Secret scanning with one deterministic automaton for all rules.

Rules are regular expressions over bytes. All of them, read backwards and free to begin anywhere, are made into one
automaton by subset construction, minimised, and laid out as transition arrays. One pass over the bytes of a text
from its end marks each position at which some rule matches. A match's end is then found forwards from its start by
the automaton of that rule, over the bytes of the match alone: the longest match at the leftmost start, and the next
one after its end.
"""

from __future__ import annotations

import functools
import hashlib
import re._constants as kinds
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import text_slices

SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))

# Code points that one task holds as Python text at once.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``head`` and ``tail`` together are the pattern; a match counts if its tail has ``least`` bytes or more.

    What ``more`` matches right after them belongs to the match too.
    """

    name: str
    head: str
    tail: str
    least: int = 1
    more: str = ""


# The base rules, in the order in which they are listed, and the forms of some providers' credentials.
BASE = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", r"", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"", r"[0-9a-f]{32,}", 32),
)
# A key after its first line: headers, and base64 up to the END line, or full lines of it where that is missing. Line ends may be escaped.
BREAK = r"(?:[\x20\t]*(?:\r?\n|\\r\\n|\\n))"
HEADERS = rf"(?:{BREAK}[A-Za-z][A-Za-z0-9-]*:[A-Za-z0-9,\x20-]*)*"
WITH_END = r"(?:[\x20\t\r\n]|\\[nr]|[A-Za-z0-9+/=])*-----END [A-Z ]*PRIVATE KEY-----"
KEY_LINES = rf"{HEADERS}(?:{WITH_END}|(?:{BREAK}+[\x20\t]*[A-Za-z0-9+/=]{{40,}})+)"
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"", 0, KEY_LINES),
    Rule("code_host", r"gh[opsur]_", r"[A-Za-z0-9]+", 36),
    Rule("chat", r"xox[abeoprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", 16),
)
RULES = BASE + MORE


class Nfa:
    """Thompson's automaton: byte sets on arcs between states, and free moves."""

    def __init__(self) -> None:
        self.arcs: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def add(self, items, start: int, back: bool, fold: bool = False) -> int:
        """The state after all items one after another, or from the last to the first when reading ``back``wards."""
        for op, arg in reversed(list(items)) if back else items:
            if op is kinds.SUBPATTERN:
                _, flags, _, inner = arg
                start = self.add(inner, start, back, fold or bool(flags & parser.SRE_FLAG_IGNORECASE))
            elif op is kinds.BRANCH:
                end = self.state()
                for option in arg[1]:
                    self.free[self.add(option, start, back, fold)].append(end)
                start = end
            elif op is kinds.MAX_REPEAT:
                least, most, inner = arg
                for _ in range(least):
                    start = self.add(inner, start, back, fold)
                if most is kinds.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.free[start] += [loop, end]
                    self.free[self.add(inner, loop, back, fold)] += [loop, end]
                    start = end
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.free[start].append(end)
                        start = self.add(inner, start, back, fold)
                    self.free[start].append(end)
                    start = end
            else:
                end = self.state()
                self.arcs[start].append((accepted(op, arg, fold), end))
                start = end
        return start

    def closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


def accepted(op, arg, fold: bool) -> frozenset[int]:
    """The bytes that a single item of a parsed pattern accepts."""
    if op is kinds.LITERAL:
        found = {arg}
    elif op is kinds.IN and all(what in (kinds.LITERAL, kinds.RANGE) for what, _ in arg):
        found = set()
        for what, value in arg:
            found |= {value} if what is kinds.LITERAL else set(range(value[0], value[1] + 1))
    else:
        raise ValueError(f"patterns are made of bytes, ranges, groups, alternatives and repeats: {op}")
    if fold:
        found |= {b ^ 32 for b in found if chr(b).isalpha()}
    return frozenset(found)


@dataclass(frozen=True)
class Dfa:
    """``moves`` has a row per state and a column per class of bytes; ``marks`` the rules accepted in a state, as bits.

    States that accept come last, from ``accepting`` on.
    """

    classes: bytes
    moves: np.ndarray
    marks: np.ndarray
    start: int
    accepting: int

    @classmethod
    def of(cls, nfa: Nfa, start: int, ends: dict[int, int], anywhere: bool) -> Dfa:
        sets = sorted({s for arcs in nfa.arcs for s, _ in arcs}, key=sorted)
        signatures: dict[tuple, int] = {}
        classes = bytes(signatures.setdefault(tuple(b in s for s in sets), len(signatures)) for b in range(256))
        sample = [classes.index(c) for c in range(len(signatures))]
        first = nfa.closed([start])
        ids, rows, todo = {first: 0}, [], [first]
        for subset in todo:  # subset construction; todo grows while it is read
            row = []
            for byte in sample:
                moved = {to for state in subset for accepts, to in nfa.arcs[state] if byte in accepts}
                following = nfa.closed(moved | {start}) if anywhere else nfa.closed(moved)
                if following not in ids:
                    ids[following] = len(ids)
                    todo.append(following)
                row.append(ids[following])
            rows.append(row)
        marks = [functools.reduce(int.__or__, (1 << ends[s] for s in subset if s in ends), 0) for subset in todo]
        return cls.minimised(classes, np.array(rows), np.array(marks), 0)

    @classmethod
    def minimised(cls, classes: bytes, moves: np.ndarray, marks: np.ndarray, start: int) -> Dfa:
        """Split states by what they accept, then by where their moves lead, until nothing splits any more."""
        group = np.unique(marks, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == group.max():
                break
            group = finer
        kept = np.unique(group, return_index=True)[1]
        order = np.argsort(marks[kept] > 0, kind="stable")
        place = np.empty(len(kept), np.int64)
        place[order] = np.arange(len(kept))
        place = place[group]
        return cls(classes, place[moves[kept[order]]], marks[kept[order]], int(place[start]), int((marks[kept] == 0).sum()))

    @functools.cached_property
    def rows(self) -> list[tuple[int, ...]]:
        return [tuple(row) for row in self.moves.tolist()]

    def longest(self, data: bytes, at: int) -> int:
        """The end of the longest match that begins at a byte, or -1."""
        state, end, rows, classes = self.start, -1, self.rows, self.classes
        dead = self.dead
        if state >= self.accepting:
            end = at
        for i in range(at, len(data)):
            state = rows[state][classes[data[i]]]
            if state >= self.accepting:
                end = i + 1
            elif state == dead:
                break
        return end

    @functools.cached_property
    def dead(self) -> int:
        stuck = np.flatnonzero((self.moves == np.arange(len(self.moves))[:, None]).all(axis=1) & (self.marks == 0))
        return int(stuck[0]) if len(stuck) else -1


class Scanner:
    """All rules in one automaton, and what finds the ends of single matches."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        nfa = Nfa()
        start, ends = nfa.state(), {}
        for number, rule in enumerate(rules):
            begin = nfa.state()
            nfa.free[start].append(begin)
            ends[nfa.add(parser.parse(rule.head + rule.tail), begin, back=True)] = number
        self.backwards = Dfa.of(nfa, start, ends, anywhere=True)
        self.whole = [self.forwards(rule.head + rule.tail + (f"(?:{rule.more})?" if rule.more else "")) for rule in rules]
        self.heads = [self.forwards(rule.head) for rule in rules]

    @staticmethod
    def forwards(pattern: str) -> Dfa:
        nfa = Nfa()
        start = nfa.state()
        return Dfa.of(nfa, start, {nfa.add(parser.parse(pattern), start, back=False): 0}, anywhere=False)

    def starts(self, data: bytes) -> list[tuple[int, int]]:
        """Each byte at which rules match, ascending, with the rules as bits: the one pass over the whole text."""
        dfa = self.backwards
        rows, first, state, last = dfa.rows, dfa.accepting, dfa.start, len(data) - 1
        found = []
        for i, c in enumerate(data.translate(dfa.classes)[::-1]):
            state = rows[state][c]
            if state >= first:
                found.append((last - i, state))
        return [(at, int(dfa.marks[state])) for at, state in reversed(found)]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``start, rule, end`` of the matches in code points, sorted; per rule leftmost, longest, not overlapping."""
        data = text.encode()
        taken, found = [0] * len(self.rules), []
        for at, marks in self.starts(data):
            for number, rule in enumerate(self.rules):
                if marks >> number & 1 and at >= taken[number]:
                    end = self.whole[number].longest(data, at)
                    taken[number] = max(end, at + 1)
                    if end - self.heads[number].longest(data, at) >= rule.least:
                        found.append((at, number, end))
        if len(data) != len(text):
            points = np.append(0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))
            found = [(int(points[a]), number, int(points[b])) for a, number, b in found]
        return sorted(found)


def listed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[number].name}:{start}:{end}" for start, number, end in spans)


def secrets_of(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, found`` with ``found`` an array of ``kind, start, end`` for each row of ``docs(doc_id, text)``.

    Positions are code points, ends are exclusive. A missing or empty text has none. Rows are independent of one
    another; nothing is shuffled.
    """
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", CHUNK):
            found = [[(rules[n].name, a, b) for a, n, b in scanner.value.spans(text)] for text in texts]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(kind))], names=["doc_id", "found"])

    schema = docs.select("doc_id").schema.add("found", SPANS)
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per base rule, a digest of the base spans, and all spans as text, for each row of ``docs``."""
    found = secrets_of(docs)
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("found", lambda x: x["kind"].isin(*[r.name for r in BASE]))
    count = lambda name: F.size(F.filter("found", lambda x: x["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        *[count(rule.name).alias(f"n_{rule.name}") for rule in BASE],
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", one), ",").alias("spans"),
    )
