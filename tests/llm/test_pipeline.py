"""The pipeline against brute force, stage by stage, and its tolerance of odd rows."""

from __future__ import annotations

import re

import public_tokenizers
import pytest

import corpus_pipeline
from quarterdeck.llm import language, toxicity
from quarterdeck.llm.common import COLUMNS, DOCUMENT, table
from quarterdeck.llm.secrets import RULES
from quarterdeck.llm.word_tokens import load
from quarterdeck.session import written
from tests.llm.test_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents").unionByName(spark.createDataFrame(
        [(70_001, None, "en", "s", 0), (70_002, " ", None, None, 0), (70_003, "123", "en", "", None),
         (None, "the and of the", "en", "s", 1), (70_004, "the and of the", "en", "s", 1)], DOCUMENT))
    given, out = docs.selectExpr("*", "1 as score", "'x' as row"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        given = written(stage(spark, given, SF), f"test-{name}")
        out.append(given)
    return out


def rows(df):
    return {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[1:-1])


def test_language_and_toxicity_follow_the_operators(spark, stages):
    found = language.identify(stages[0], public_tokenizers.path("piece_bpe_32k.model")).collect()
    kept = sorted((str(r.doc_id) for r in found if r.lang_pred != "und" and r.score >= 0.5))
    assert sorted(str(r.doc_id) for r in stages[1].collect()) == kept
    assert not rows(stages[1]) & {(70_001, None), (70_002, " "), (70_003, "123")}
    assert stages[1].count() > 0.97 * (stages[0].count() - 3)
    found = toxicity.toxicity(stages[1], table(spark, SF, "labels")).collect()
    assert sorted(str(r.doc_id) for r in stages[2].collect()) == \
        sorted(str(r.doc_id) for r in found if not r.predicted)


def test_one_of_each_group(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    groups = brute(before)
    assert stages[3].count() == len({c for _, _, c in groups})
    assert {d for d, _ in rows(stages[3])} == {c for _, _, c in groups}


def test_no_secret_is_left(stages):
    assert stages[4].count() == stages[3].count()
    texts = dict(rows(stages[3]))
    for r in stages[4].collect():
        assert not any(len(m[rule.value_group]) >= rule.least for rule in RULES
                       for m in re.finditer(rule.pattern, r.text.replace("<secret>", "|")))
        if "<secret>" not in r.text:
            assert r.text == texts[r.doc_id]


def test_every_token_is_packed(stages):
    plain = load(public_tokenizers.path("word_bpe_49k.json"))
    meant = {r.doc_id: len(plain.encode(r.text, add_special_tokens=False).ids) + 1
             for r in stages[4].collect()}
    found = {}
    for r in stages[5].collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == meant


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENT)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
