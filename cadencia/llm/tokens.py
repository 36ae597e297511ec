"""Token ids of whole texts, each different word encoded once.

Where a tokenizer never joins what blanks part, a text's ids are those of its words in a row. Words recur, so workers keep what they
have encoded from batch to batch.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Words kept; beyond that a worker starts afresh.
KEPT_WORDS = 400_000

#: Letters that are one code point in either case, which no normalisation touches, and punctuation after them.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file's bytes, so that tasks need not see the driver's file system."""
    with open(path, "rb") as file:
        return file.read()


def from_json(vocabulary: bytes, plain_specials: bool):
    """A tokenizer of the ``tokenizers`` library; with ``plain_specials`` special strings inside texts are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(vocabulary)
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


class WordIds:
    """Ids of UTF-8 texts by a lower-casing tokenizer that drops blanks, never reaches across them and marks the ends of words.

    Words are what ``bytes.split`` gives: runs without ASCII blanks. Other blanks stay inside a word and are the tokenizer's.
    """

    def __init__(self, vocabulary: bytes):
        self.tokenizer = from_json(vocabulary, plain_specials=False)
        suffix = self.tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the tokenizer does not mark the ends of words")
        ends = [i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.is_end[ends] = True
        self.ids: dict[bytes, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters, which are encoded in one text: each ends where its last token says."""
        if not words:
            return []
        (found,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(words):
            return self._each(words)
        data, at, out = ids.tobytes(), 0, []
        for end in (ends * 4).tolist():
            out.append(data[at:end])
            at = end
        return out

    def _learn(self, words: list[bytes]) -> None:
        parts, others = [], []
        for word in words:
            text = word.decode()
            plain = _PLAIN.fullmatch(text)
            if plain:
                parts.append((word, plain[1].lower(), plain[2]))
            else:
                others.append((word, text))
        stems = list({stem for _, stem, _ in parts})
        tails = list({tail for _, _, tail in parts})
        of_stem, of_tail = dict(zip(stems, self._letters(stems))), dict(zip(tails, self._each(tails)))
        for word, stem, tail in parts:
            self.ids[word] = of_stem[stem] + of_tail[tail]
        for (word, _), found in zip(others, self._each([t for _, t in others])):
            self.ids[word] = found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.ids) > KEPT_WORDS:
            self.ids.clear()
        split = [t.split() for t in texts]
        self._learn(list(set().union(*split) - self.ids.keys()))
        get = self.ids.__getitem__
        return [b"".join(map(get, words)) for words in split]
