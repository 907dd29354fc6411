from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import docs, none

from scoreloom.llm.secrets import BASE, Rule, Scanner, secret_report

SCANNER = Scanner()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


PARTS = ["token", "PASSWORD", "secret", "api_key", "ApiKey", "passwd", "=", ":", " ", "'", '"', "abcdefgh1", "AKIA", "ABCDEF012345"]
PARTS += ["x", "é", "😀", "0123456789abcdef" * 2, "aaaa", "-", "\n"]


@given(st.lists(st.sampled_from(PARTS), max_size=25))
@settings(max_examples=400, deadline=None)
def test_base_spans_are_those_of_the_expressions(parts):
    text = "".join(parts)
    assert [s for s in SCANNER.spans(text) if s[1] < len(BASE)] == base_spans(text)


@given(st.text("ab", max_size=14))
@settings(max_examples=200, deadline=None)
def test_leftmost_longest(text):
    rules = (Rule("r", "", "(ab|a|ba{2,3})+b?"), Rule("s", "b", "a*b"))
    scanner = Scanner(rules)
    wanted = []
    for number, rule in enumerate(rules):
        at = 0
        while at < len(text):
            ends = [e for e in range(at + 1, len(text) + 1) if re.fullmatch(rule.head + rule.tail, text[at:e])]
            if ends:
                wanted.append((at, number, ends[-1]))
            at = ends[-1] if ends else at + 1
    assert scanner.spans(text) == sorted(wanted)


def test_minimal_automaton():
    both = Scanner((Rule("a", "", "xa|xb"), Rule("b", "", "x[ab]")))
    assert len(both.whole[0].moves) == len(both.whole[1].moves) == 4


def test_more_rules():
    text = "ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc"
    assert [SCANNER.rules[n].name for _, n, _ in SCANNER.spans(text)] == ["code_host", "private_key", "chat"]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", " "])
def test_private_keys_are_marked_to_their_end(end):
    begin, stop = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    lines = ["MIIEpAIBAAKCAQEA+/" + "x1Y2" * 11, "Zm9v" * 16, "YmFy=="]
    headers = [] if end == " " else ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF", ""]
    key = end.join([begin, *headers, *lines, stop])
    keys = lambda text: [text[a:b] for a, n, b in SCANNER.spans(text) if SCANNER.rules[n].name == "private_key"]
    assert keys(f"é {key}{end}{key} and more") == [key, key]
    assert keys(f"{begin} is a first line, {stop} a last one") == [begin]
    if end != " ":
        cut = end.join([begin, *headers, *lines[:2]])
        assert keys(f"{cut}{end}And text.") == [cut]


def test_report(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").unionByName(docs(spark).select("doc_id", "text"))
    texts = [(r["doc_id"], r["text"] or "") for r in table.collect()]
    got = secret_report(table).collect()
    wanted = []
    for i, text in texts:
        spans = base_spans(text)
        listed = ",".join(f"{('assign', 'access', 'hex')[n]}:{a}:{b}" for a, n, b in spans)
        wanted.append((str(i), *(sum(n == k for _, n, _ in spans) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:5]) for r in got) == sorted(wanted)
    assert secret_report(none(spark)).count() == 0


def test_unknown_syntax():
    with pytest.raises(ValueError):
        Scanner((Rule("x", "", r"\w+"),))
