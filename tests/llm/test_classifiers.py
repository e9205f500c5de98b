"""Language and toxicity: sums over segmentations, smoothing, held-out accuracy, odd rows."""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from quarterdeck.llm import language, toxicity
from quarterdeck.llm.common import DOCUMENT, table

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
LABEL = "doc_id long, quality int, toxic int"


def all_segmentations(word, pieces, chances):
    marked, total = language.START + word, 0
    for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(marked)]
        chance = 1
        for a, b in itertools.pairwise(at):
            part = marked[a:b]
            k = pieces.index(part) if part in pieces else -1 if len(part) == 1 else None
            chance = chance * chances[k] if k is not None else 0
        total = total + chance
    return np.log(total)


def test_forward_equals_the_sum_over_segmentations():
    pieces = sorted(["a", "b", "ab", "ba", "aab", language.START + "a", language.START + "ab",
                     language.START])
    chances = np.random.default_rng(1).random((len(pieces) + 1, 3)) / 10
    model = language.LanguageModel(["x", "y", "z"], pieces, chances)
    words = ["a", "abab", "aabxba", "bbb", "xaab"]
    model.learn(set(words))
    for w in words:
        meant = all_segmentations(w, pieces, chances)
        assert np.allclose(model.text([w]), meant) and np.allclose(model._long(w), meant)
    long = "abx" * 3000
    assert np.isfinite(model._long(long)).all()


ODD = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "123 !? ²", None, None, 0),
       (None, "the and of", "en", "s", 0), (4, "x" * 60000, "de", "s", 0),
       (4, "x" * 60000, "de", "s", 0), (5, "日本語", None, "s", 0)]


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame(ODD, DOCUMENT)
    found = language.identify(docs.unionByName(odd).selectExpr("*", "1 as score"), PATH)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth and r.doc_id > 5]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_id = {r.doc_id: r for r in rows[-len(ODD):]}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[None].held_out is False and by_id[None].lang_pred == "en"
    assert by_id[5].lang_pred in set(truth.values())
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == docs.count() + len(ODD)


def test_language_without_training_rows(spark):
    odd = spark.createDataFrame(ODD, DOCUMENT).withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(odd, PATH).collect()} == {"und"}
    assert language.identify(odd.limit(0), PATH).count() == 0


def test_chances_of_a_history_sum_to_one():
    counts = {0: {"^a": 5, "^ab": 4, "^ab$": 3, "^aba": 1}, 1: {"^a": 2, "^ac": 2, "^ac$": 2}}
    model = toxicity.build(counts)
    assert model.ratio["^ac"] > 0 > model.ratio["^ab"]
    # a letter that neither class has after this history: only the freed mass tells them apart
    assert model.history["^ab"] == pytest.approx(-math.log(0.75 * 2 / 4))
    assert model.history.get("zzz", 0.0) == 0.0


def test_toxicity_of_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    odd_labels = spark.createDataFrame([(2, 0, None), (None, 0, 1), (900_001, 1, 0)], LABEL)
    rows = toxicity.toxicity(
        docs.unionByName(spark.createDataFrame(ODD, DOCUMENT)).selectExpr("*", "'x' as predicted"),
        labels.unionByName(odd_labels).selectExpr("*", "'y' as text")).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth and r.doc_id > 5]
    toxic = [r.predicted for r, t in held if t == 1]
    clean = [r.predicted for r, t in held if t == 0]
    assert len(toxic) > 5 and sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert len(rows) == docs.count() + len(ODD)
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert any(r.predicted == 0 for r in empty)


def test_toxicity_without_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    assert {(r.score, r.predicted) for r in
            toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_ratio_table_equals_the_ratios_in_memory(spark):
    rng, counts = np.random.default_rng(3), {}
    for label, letters in ((0, "abcde"), (1, "cdefé語")):
        found = toxicity.Counter()
        for _ in range(300):
            found.update(toxicity.grams("".join(rng.choice(list(letters), rng.integers(1, 8)))))
        counts[label] = dict(found)
    rows = [(m, c, g, n + m) for m in (0, 1) for c, own in counts.items() for g, n in own.items()]
    found = toxicity.ratios(spark.createDataFrame(
        rows, "model int, toxic int, gram string, n long")).collect()
    for m in (0, 1):
        meant = toxicity.build({c: {g: n + m for g, n in own.items()}
                                for c, own in counts.items()})
        own = {r.gram: r.value for r in found if r.model == m}
        meant = meant.ratio | {h + toxicity.HISTORY: v for h, v in meant.history.items()}
        assert own == pytest.approx(meant, rel=1e-12)
    assert len(found) == 2 * len(meant)


def test_words_met_once_count_however_many_there_are(spark):
    """About 540,000 grams; held-out documents have only words that one learnt document has."""
    rng, letters = np.random.default_rng(4), np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def some(n):
        return ["".join(w) for w in letters[rng.integers(0, 26, (n, 9))]]

    common, once = (some(10), some(10)), ([], [])
    texts, held = {}, [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    for i in set(range(600)) - set(held):  # odd ids are toxic
        new = some(150)
        once[i % 2].extend(new)
        texts[i] = common[i % 2] + new
    for i in held:
        texts[i] = rng.choice(once[i % 2], 2)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in texts], LABEL)
    rows = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    assert len(rows) == len(held) > 100
    clean, toxic = ([r.score for r in rows if r.doc_id % 2 == c] for c in (0, 1))
    # the common words set the curve; these words lie below its middle, but apart from each other
    assert np.mean([a < b for a, b in itertools.product(clean, toxic)]) > 0.999


@pytest.mark.parametrize("without", [0, 2])
def test_toxicity_where_a_training_fold_has_no_toxic_document(spark, without):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    fewer = labels.where((toxicity.F.col("toxic") == 0)
                         | (toxicity.fold("doc_id", toxicity.FOLDS) != without))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.toxicity(docs, fewer).collect() if r.held_out]
    toxic = [r.predicted for r in rows if truth.get(r.doc_id) == 1]
    clean = [r.predicted for r in rows if truth.get(r.doc_id) == 0]
    assert sum(toxic) / len(toxic) > 0.4 and sum(clean) / len(clean) < 0.05


def test_the_curve_is_drawn_from_both_classes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "CURVE_ROWS", 4)
    monkeypatch.setattr(toxicity, "fit_curve", lambda x, toxic: (seen.extend(toxic), (1.0, 0.0))[1])
    toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert sorted(seen) == [0, 0, 1, 1]
