"""Language of a text by unigram models whose segmentations are summed out.

The pieces come from a fixed public vocabulary; each language has a probability for each piece.
The likelihood of a word is the sum, over all its segmentations into pieces, of the product of the
pieces' probabilities (the forward algorithm); that of a text is the product over its words.

Training counts how often each piece occurs in the words of all training documents of a language.
Words are counted in the tasks, then by Spark; only the counts of pieces (vocabulary times
languages) reach the driver and go back to the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import STORES, arrow_map, fold, utf8, with_columns

WORD = re.compile(r"[^\W\d_]+")
START = "▁"  # fixed value: the vocabulary's mark of a word's start
FOLDS, KEPT_WORDS, COUNTED_WORDS = 5, 250_000, 200_000
WORDS_TOGETHER = 100_000  # of the texts that are looked up at once
SHORT = 40  # letters; longer words take a forward pass of their own, rescaled on its way
UNKNOWN = "und"


def vocabulary(path: str) -> list[str]:
    """Pieces of letters, with or without the mark of a word's start, lower case only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p == p.lower()
                   and (p == START or WORD.fullmatch(p.removeprefix(START)))})


class Pieces:
    """Looks up the pieces that occur in a word; a prefix tree as a dictionary."""

    def __init__(self, pieces: list[str]) -> None:
        self.known = {p[:i]: -1 for p in pieces for i in range(1, len(p) + 1)}
        self.known |= {p: k for k, p in enumerate(pieces)}
        self.other = len(pieces)  # stands for a letter that is no piece

    def packed(self, word: str, row: int) -> list[int]:
        """``within`` for a short word as numbers that sort by end, then row: 8 bits for the end,
        20 for the row, 8 for the start, 20 for the piece."""
        word, found, get, other = START + word, [], self.known.get, self.other
        put, here, n = found.append, row << 28, len(word)
        for i in range(n):
            k = get(word[i], -1)
            put((i + 1) << 48 | here | (k if k >= 0 else other))
            for j in range(i + 2, n + 1):
                k = get(word[i:j])
                if k is None:
                    break
                if k >= 0:
                    put(j << 48 | here | k)
            here += 1 << 20
        return found

    def within(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece) for every piece in the marked word and every unknown letter."""
        word, found, known = START + word, [], self.known
        n = len(word)
        for i in range(n):
            single = known.get(word[i], -1)
            found.append((i, i + 1, single if single >= 0 else self.other))
            for j in range(i + 2, n + 1):
                k = known.get(word[i:j])
                if k is None:
                    break
                if k >= 0:
                    found.append((i, j, k))
        return found


class LanguageModel:
    """Log-likelihoods of words under each language; ``chances`` is pieces + 1 by languages."""

    def __init__(self, languages: list[str], pieces: list[str], chances: np.ndarray) -> None:
        self.languages, self.pieces, self.chances = languages, Pieces(pieces), chances
        self.place: dict[str, int] = {}
        self.logs = np.zeros((1024, len(languages)))
        self.old: tuple[dict[str, int], np.ndarray] = ({}, self.logs)

    def _long(self, word: str) -> np.ndarray:
        ends: dict[int, list[tuple[int, int]]] = {}
        for i, j, k in self.pieces.within(word):
            ends.setdefault(j, []).append((i, k))
        scale = np.zeros(len(self.languages))
        alpha = {0: np.ones(len(self.languages))}
        reach = max(map(len, self.pieces.known), default=1)
        for j in range(1, len(word) + 2):
            alpha[j] = sum(alpha[i] * self.chances[k] for i, k in ends[j])
            alpha.pop(j - reach - 1, None)
            if j % 16 == 0:
                top = alpha[j].copy()
                scale += np.log(top)
                alpha = {i: a / top for i, a in alpha.items()}
        return scale + np.log(alpha[len(word) + 1])

    def _short(self, words: list[str]) -> np.ndarray:
        """All words at once, position by position."""
        hits = []
        for row, word in enumerate(words):
            hits += self.pieces.packed(word, row)
        hits = np.sort(np.array(hits, np.int64))
        ends, rows = hits >> 48, hits >> 28 & 0xFFFFF
        starts, pieces = hits >> 20 & 0xFF, hits & 0xFFFFF
        longest = int(ends[-1])
        alpha = np.zeros((longest + 1, len(words), len(self.languages)))
        alpha[0] = 1
        bounds = np.searchsorted(ends, np.arange(1, longest + 2))
        for j in range(1, longest + 1):
            own = slice(bounds[j - 1], bounds[j])
            row, start, piece = rows[own], starts[own], pieces[own]
            first = np.append(0, np.flatnonzero(row[1:] != row[:-1]) + 1)
            alpha[j, row[first]] = np.add.reduceat(alpha[start, row] * self.chances[piece], first)
        return np.log(alpha[[len(w) + 1 for w in words], np.arange(len(words))])

    def learn(self, words: set[str]) -> None:
        """Remember the log-likelihoods of these words. When there are many, those not met since
        the last time are forgotten."""
        if len(self.place) > KEPT_WORDS:
            self.old, self.place = (self.place, self.logs), {}
            self.logs = np.zeros((KEPT_WORDS + 1024, len(self.languages)))
        new = [w for w in words if w not in self.place]
        if new and self.old[0]:
            place, logs = self.old
            again = [w for w in new if w in place]
            if again:
                self._put(again, logs[[place[w] for w in again]])
                new = [w for w in new if w not in place]
        for start in range(0, len(new), 5000):
            some = sorted(new[start:start + 5000], key=len)
            short = [w for w in some if len(w) <= SHORT]
            self._put(some, np.concatenate(([self._short(short)] if short else []) + [
                self._long(w)[None] for w in some[len(short):]]))

    def _put(self, words: list[str], logs: np.ndarray) -> None:
        at = len(self.place)
        if at + len(logs) > len(self.logs):
            grown = np.zeros((2 * (at + len(logs)), len(self.languages)))
            grown[:at] = self.logs[:at]
            self.logs = grown
        self.logs[at:at + len(logs)] = logs
        self.place.update(zip(words, range(at, at + len(words))))

    def text(self, words: list[str]) -> np.ndarray:
        """Sum of the words' log-likelihoods, by language; the words must be learnt."""
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self.logs[at].sum(axis=0)


def _count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[str, Counter] = {}

        def rows() -> dict:
            keys = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            return dict(zip(("lang", "word", "n"), zip(*keys))) if keys else {
                "lang": [], "word": [], "n": []}

        for batch in batches:
            for text, lang in zip(batch["utf8"], batch["lang"].to_pylist()):
                counts.setdefault(lang, Counter()).update(
                    WORD.findall(text.as_py().decode().lower()))
                if sum(map(len, counts.values())) > COUNTED_WORDS:
                    yield rows()
        yield rows()

    return (arrow_map(docs.select(utf8().alias("utf8"), F.col("lang")), run,
                      "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, path: str, smoothing: float = 0.5) -> LanguageModel:
    """Learn from every document with a non-null lang; no others may be given."""
    pieces = vocabulary(path)
    counts = _count_words(docs.where(F.col("lang").isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        lookup, totals = Pieces(pieces), {}
        for batch in batches:
            found: dict[str, tuple[list[int], list[int]]] = {}
            for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n"))):
                ids, times = found.setdefault(lang, ([], []))
                inside = lookup.packed(word, 0)
                ids += inside
                times += [n] * len(inside)
            for lang, (ids, times) in found.items():
                total = totals.setdefault(lang, np.zeros(len(pieces) + 1, np.int64))
                np.add.at(total, [k & 0xFFFFF for k in ids], times)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield {"lang": [lang] * len(used), "piece": used, "n": total[used]}

    rows = (arrow_map(counts, run, "lang string, piece int, n long")
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    table = np.zeros((len(pieces) + 1, len(languages)))
    for i, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        table[own["piece"], i] = own["n"]
    table[-1] = table[-1].sum()  # a letter outside the vocabulary says nothing of the language
    chances = (table + smoothing) / (table + smoothing).sum(axis=0, keepdims=True) if languages \
        else table
    return LanguageModel(languages, pieces, chances)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score, the posterior chance of the language under
    equal priors. Null texts and texts without a letter, or a model without languages: ``und``, 0.

    Columns of these names are replaced. The text alone decides.
    """
    given = docs.sparkSession.sparkContext.broadcast(
        (model.languages, list(model.pieces.known.items()), model.chances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = _model(given)
        for batch in batches:
            langs, scores = [], []
            for some in _together(batch[batch.schema.names.index("text")]):
                if mine.languages:
                    mine.learn(set().union(*some))
                for words in some:
                    if not mine.languages or not any(c.isalpha() for w in words for c in w):
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    logs = mine.text(words)
                    best = int(np.argmax(logs))
                    langs.append(mine.languages[best])
                    scores.append(float(1 / np.exp(logs - logs[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    return kept.mapInArrow(run, with_columns(kept, "lang_pred string, score double"))


def _together(texts: pa.Array) -> Iterator[list[list[str]]]:
    """The words of each text, in order, for some texts at a time: new words of many texts take one
    forward pass."""
    some, size = [], 0
    for text in texts:
        some.append(WORD.findall((text.as_py() or "").lower()))
        size += len(some[-1])
        if size > WORDS_TOGETHER:
            yield some
            some, size = [], 0
    if some:
        yield some


_models: dict[int, LanguageModel] = {}
STORES[__name__] = _models.clear


def _model(given) -> LanguageModel:
    """One model per process and broadcast, so that tasks share the words it has met."""
    if id(given.value) not in _models:
        languages, known, chances = given.value
        made = LanguageModel(languages, [], chances)
        made.pieces.known, made.pieces.other = dict(known), len(chances) - 1
        _models.clear()
        _models[id(given.value)] = made
    return _models[id(given.value)]


def identify(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document. Training uses the documents outside
    fold 0 of crc32(doc_id) mod 5 that have a lang; a null doc_id has no fold and is not learnt."""
    held = fold("doc_id", FOLDS) == 0
    model = train(documents.where(~held).select("text", "lang"), path)
    found = predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred",
                        "score")
