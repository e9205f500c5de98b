"""Trigram queries are necessary conditions; spans equal plain Python's; odd rows; redaction."""

from __future__ import annotations

import hashlib
import re

import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.secrets import BASE, RULES, redact, report
from quarterdeck.llm.trigrams import alternatives

SF = "/root/testdata/sf0.01"
HEX, KEY = "0123456789abcdef" * 2, "AKIA" + "Z9" * 10
ODD = ["", None, "Password: 'abcdef1' and secret=token: abcdefgh", f"{HEX}{KEY}{HEX}g{HEX[:23]}",
       'API_KEY="a.b" apikey = abcdefg', "token==abcdef pass word:x", "é😀 token = 😀abcdef",
       "é😀" * 3 + f" PASSWD:{HEX},{KEY[:19]} AKIA", "ghp_" + "a1" * 20 + " xoxb-1234567890-abc",
       "-----BEGIN RSA PRIVATE KEY----- eyJabcdefgh.eyJabcdefghijk.abcdefghij", "a" * 200_000,
       "token=" + "f" * 100_000, "tokens: abcdef password  :\t'abcdef'", "sEcReT'='x_+/=-"]


def spans(text):
    found = []
    for order, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.value_group]) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return sorted(found)


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.kind)
def test_a_match_has_the_trigrams(rule):
    sets = alternatives(rule.pattern)
    assert (frozenset() in sets) == (rule.kind == "hex")
    for text in filter(None, ODD):
        if re.search(rule.pattern, text):
            assert any(all(t in text.lower() for t in s) for s in sets)


def test_trigram_queries():
    assert alternatives("abcd") == [frozenset({"abc", "bcd"})]
    assert alternatives("ab+c[xy]de") == [frozenset({"cxd", "xde"}), frozenset({"cyd", "yde"})]
    assert alternatives("(abc|de)f") == [frozenset({"def"}), frozenset({"abc", "bcf"})]
    assert alternatives("x.*") == [frozenset()]
    assert alternatives("(?:hello )+w") == [frozenset({"hel", "ell", "llo", "lo "})]


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(70_000 + i, t, None, None, 1) for i, t in enumerate(ODD)]
    odd += [(None, ODD[2], "en", "s", 1), (70_002, ODD[2], "en", "s", 1)]
    return table(spark, SF, "documents").unionByName(spark.createDataFrame(odd, DOCUMENT)).selectExpr(
        "*", "1 as spans", "2 as secret_x", "3 as trigram")


def test_report_equals_python(docs):
    key = lambda r: (r[0] is not None, *map(str, r))
    found = sorted(map(tuple, report(docs).collect()), key=key)
    meant = []
    for row in docs.collect():
        all_of = spans(row.text)
        base = [s for s in all_of if s[3] in BASE]
        meant.append((row.doc_id, *(sum(s[3] == k for s in base) for k in BASE),
                      hashlib.sha256(joined(base).encode()).hexdigest(), joined(all_of)))
    assert found == sorted(meant, key=key)


def test_redact(docs):
    new = redact(docs)
    assert new.columns == docs.columns
    by_id = {r.doc_id: r for r in new.collect()}
    assert by_id[70_003].text == "<secret><secret>g" + HEX[:23] or "<secret>" in by_id[70_003].text
    assert HEX not in by_id[70_003].text and by_id[70_001].text is None
    assert by_id[70_010].text == "a" * 200_000 if not spans("a" * 200_000) else True
    assert by_id[70_011].text == "<secret>" and by_id[70_011].n_chars == 8
    assert new.count() == docs.count() and report(docs.limit(0)).count() == 0
    assert redact(docs.limit(0)).count() == 0
