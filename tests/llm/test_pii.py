"""Base spans against the plain expressions, and discovery from contexts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from quarterdeck.llm.common import DOCUMENT, table
from quarterdeck.llm.pii import KINDS, base_spans, find_personal_data, luhn

SF = "/root/testdata/sf0.001"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, expression in PLAIN.items():
        for m in re.finditer(expression, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_expressions():
    rng = random.Random(8)
    pieces = ["a", "B.", "@", "x@y", ".com", "1", "23", "255", "256", ".", "-", " ", "+", "(", ")",
              "_", "%", "é", "😀", "4111 1111 1111 1111", "10.0.0.1", "007", "+1 (23) 45-67 89", "²"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30)))
        assert base_spans(text) == plain_spans(text)
    assert base_spans("a" * 300_000 + "1" * 300_000) == []
    assert not luhn("4111111111111112") and luhn("4111111111111111")


@pytest.fixture(scope="module")
def docs(spark):
    texts = [f"please write mail me{i}@host{i}.org today, thanks" for i in range(12)]
    texts += ["please write mail user-7734-x today, thanks", "unseen other 99887766 words",
              "", None, "😀 mail me@x.yz today", "x" * 100_000, "9" * 100_000]
    rows = [(50_000 + i, t, None, None, 0) for i, t in enumerate(texts)]
    rows += [(None, "+49 (30) 12345678", "", "", 0), (50_000, texts[0], "", "", 0)]
    return table(spark, SF, "documents").unionByName(spark.createDataFrame(rows, DOCUMENT)).selectExpr(
        "*", "1 as row", "2 as met", "'x' as pattern")


def test_report(docs):
    rows = find_personal_data(docs).collect()
    found, more = [], {}
    for r in rows:
        own = r.spans.split(",") if r.spans else []
        base = [s for s in own if not s.startswith("context")]
        found.append((r.doc_id, *(r[f"n_{k}"] for k in KINDS), r.base_sha256, ",".join(base)))
        more.setdefault(r.doc_id, []).extend(s for s in own if s.startswith("context"))
        assert own == base + own[len(base):]
    meant = []
    for r in docs.select("doc_id", "text").collect():
        spans = plain_spans(r.text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        meant.append((r.doc_id, *(sum(s[0] == k for s in spans) for k in KINDS),
                      hashlib.sha256(text.encode()).hexdigest(), text))
    assert sorted(found, key=str) == sorted(meant, key=str)
    assert more[50_012] == ["context:18:29"] and more[50_013] == []
    assert find_personal_data(docs.limit(0)).count() == 0
