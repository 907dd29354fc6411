"""Quality rules against plain loops; frequent lines, copies and odd rows."""

from __future__ import annotations

import random
import re

import odd
import pytest
from compare import connect, differences

from scoreloom.llm.lines import LineRules
from scoreloom.llm.queries import ORACLE, QUERIES

WORD = r"[^\x20\x09-\x0D]+"
NORMAL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")


def normal(line):
    return " ".join(re.findall(WORD, line.translate(NORMAL)))


def plain(rows, rules):
    """``(doc_id, counts..., base_failed, kept), cleaned`` of each row ``(doc_id, source, text)``."""
    hosts, lines = {}, {}
    for _, host, text in rows:
        text = text or ""
        hosts.setdefault(host, set()).add(text)
        for line in text.split("\n"):
            if normal(line):
                lines.setdefault((host, normal(line)), set()).add(text)
    often = {k for k, t in lines.items() if len(t) > rules.most_documents and 100 * len(t) > rules.most_percent * len(hosts[k[0]])}
    found = []
    for doc_id, host, text in rows:
        text = text or ""
        words = re.findall(WORD, text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        where = {}
        for i, w in enumerate(windows):
            where.setdefault(w, []).append(i)
        inside = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(5)}
        own = [line for line in text.split("\n") if normal(line)]
        kept_lines = [line for line in text.split("\n") if (host, normal(line)) not in often]
        left = sum(len(re.findall(WORD, line)) for line in kept_lines)
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        kept = not failed and left >= rules.least_words and 100 * left >= rules.least_percent * len(words)
        counts = (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(own) - len(set(own)), len(inside), left)
        found.append(((doc_id, *counts, failed, kept), "\n".join(kept_lines)))
    return found


def by_key(rows):
    return sorted(rows, key=repr)


def test_against_plain_loops(spark):
    draw = random.Random(1)
    shared = ["Share this Page 2024", "share  this\tpage 1999", "All rights reserved # 1", "\r"]
    words = [f"w{i}" for i in range(30)] + ["é*", "$%", "ß"]
    rows = []
    for i in range(120):
        lines = [draw.choice(shared) if draw.random() < 0.3 else " ".join(draw.choices(words, k=draw.randint(0, 9))) for _ in range(draw.randint(0, 8))]
        rows.append((i, draw.choice(["a", "a", "a", "b", None]), "\n".join(lines)))
    rows += [rows[3], (None, "a", rows[5][2]), (7, None, None), (8, "b", "x y z v w " * 40), (9, "a", "\n".join(shared * 3))]
    rules = LineRules(most_documents=5, most_percent=4, least_words=10, least_percent=60)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    wanted = plain(rows, rules)
    assert by_key(map(tuple, rules.report(docs).collect())) == by_key(r for r, _ in wanted)
    assert by_key(r["text"] for r in rules.cleaned(docs).collect()) == by_key(t for r, t in wanted if r[-1])
    verdicts = {(r[-2], r[-1]) for r, _ in wanted}
    assert verdicts == {(True, False), (False, True), (False, False)}


def test_copies_alone_make_no_line_frequent(spark):
    text = "one two three four five six\nseven eight nine ten eleven"
    docs = spark.createDataFrame([(i, "a", text) for i in range(100)], "doc_id long, source string, text string")
    assert all(r["kept"] for r in LineRules(most_documents=1).report(docs).collect())


def test_query(spark, data):
    assert differences(QUERIES["op12_quality_rules"](spark, data), connect(data), ORACLE["op12_quality_rules"]) == []


@pytest.mark.parametrize("rules", [LineRules(), LineRules(most_documents=1, most_percent=0)])
def test_odd_rows(spark, rules):
    rows = [(r[0], r[3], r[1]) for r in odd.rows()]
    docs = odd.docs(spark)
    assert by_key(map(tuple, rules.report(docs).collect())) == by_key(r for r, _ in plain(rows, rules))
    assert rules.cleaned(docs).columns == docs.columns
    assert rules.report(odd.none(spark)).count() == 0 and rules.cleaned(odd.none(spark)).count() == 0
