"""Token ids of whole texts for a tokenizer that lowers case and drops white space.

No token of such a tokenizer reaches over a space or a line end, so a text's ids are the ids of
its space-separated words, one after another. Words repeat, so each task keeps the ids of the words
it has met; new words are encoded together by the tokenizers library in one call.
"""

from __future__ import annotations

import os

import numpy as np

SLICE = 1 << 20  # bytes of a text that are split into words at once
KEPT_BYTES = 128 << 20  # of words and ids that a process keeps


def _byte_letters() -> str:
    """The letters by which byte-level vocabularies spell bytes 0 to 255: printable Latin-1
    bytes stand for themselves, the others for the letters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(other)) for b in range(256))


BYTE_LETTERS = dict(enumerate(_byte_letters()))


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


class WordTokens:
    """``encode(utf8)`` gives the ids of a text as little-endian 32-bit integers."""

    _open: dict[str, WordTokens] = {}

    def __init__(self, path: str, between: str = "<|startoftext|>") -> None:
        self.tokenizer = load(path)
        self.between, self.between_id = between, self.tokenizer.token_to_id(between)
        self.model = self.tokenizer.model
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.ids: dict[bytes, bytes] = {}
        self.kept = 0

    @classmethod
    def at(cls, path: str) -> WordTokens:
        """One per process, so that tasks of one Python worker share what it has met."""
        return cls._open.get(path) or cls._open.setdefault(path, cls(path))

    def encode(self, text: bytes) -> bytes:
        if b"<|" in text:  # may hold a special token, which is found before case is lowered
            return np.array(self._plain(text.decode()), "<u4").tobytes()
        return b"".join(self._words(part) for part in _slices(text))

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _words(self, text: bytes) -> bytes:
        # Lowering A-Z first changes nothing: the tokenizer lowers every letter itself.
        words = text.lower().replace(b"\n", b" ").split(b" ")
        if self.kept > KEPT_BYTES:
            self.ids, self.kept = {}, 0
        new = set(words).difference(self.ids)
        if new:
            self._learn(new)
        return b"".join(map(self.ids.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        """A word after whose last ASCII letter only dots and commas stand is cut there."""
        cut, parts = [], set()
        for w in words:
            if w[-1:] in (b".", b","):
                stem = w.rstrip(b".,")
                if stem[-1:].isalpha():
                    cut.append((w, stem, w[len(stem):]))
                    parts.update(cut[-1][1:])
                    continue
            parts.add(w)
        self._ask(parts.difference(self.ids))
        for w, stem, tail in cut:
            self._keep(w, self.ids[stem] + self.ids[tail])

    def _ask(self, words: set[bytes]) -> None:
        """A word of plain letters is one unit of the library's BPE model; any other word goes
        through the whole tokenizer, all of them at once with a special token between them."""
        other, packed, tokenize = [], self.packed, self.model.tokenize
        for word in words:
            if word.isalpha():  # ASCII letters, lowered before
                spelt = word.decode()
            else:
                letters = word.decode()
                if not letters.isalpha() or max(letters) >= "\u0250" or "\u0130" in letters:
                    other.append(word)
                    continue
                spelt = letters.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
            self._keep(word, b"".join([packed[t.id] for t in tokenize(spelt)]))
        self._ask_whole(other)

    def _ask_whole(self, words: list[bytes]) -> None:
        if not words:
            return
        ids = np.array(self._plain(self.between.join(w.decode() for w in words)), "<u4")
        ends = np.append(np.flatnonzero(ids == self.between_id), len(ids)).tolist()
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self._keep(word, raw[4 * start:4 * end])
            start = end + 1

    def _keep(self, word: bytes, ids: bytes) -> None:
        self.ids[word] = ids
        self.kept += len(word) + len(ids) + 130


def _slices(text: bytes):
    start = 0
    while len(text) - start > SLICE:
        end = text.find(b" ", start + SLICE)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text
