"""Token ids of a public word-level BPE, with a cache of whole words.

The tokenizer drops white space and never merges across it, so a text's ids
are those of its words one after another.  Each worker process keeps the ids
of the words it has met (bounded; started anew when full), and only a new
word is given to the tokenizer.
"""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np

CACHE_BYTES = 40_000_000  # what each of the two generations of the cache may hold
ENTRY_BYTES = 160  # of a short word and its ids, besides their lengths
LONGEST = 64  # characters of a word that is cached; longer ones (scripts without spaces) seldom come again
TAIL = ".,!?;:*$%#&|)"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def _ends_plainly(core: str) -> bool:
    """Whether the normalised word still ends in a letter or digit; some letters become a letter and a mark, which joins the punctuation."""
    last = core[-1]
    return last.isascii() or unicodedata.category(unicodedata.normalize("NFC", last).lower()[-1])[0] in "LN"


class WordTokenizer(dict):
    """Ids of words, as little-endian unsigned 32-bit bytes; a word that is not there yet is encoded.

    Words of about CACHE_BYTES become the older generation, whose words come
    back when they are met again; the one before it is dropped.  Long words
    are not held at all.
    """

    _open: dict[str, WordTokenizer] = {}

    @classmethod
    def open(cls, path: str) -> WordTokenizer:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.letters = {i: c for i, c in enumerate(byte_letters())}

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        if self.held > CACHE_BYTES:
            self.older, self.held = dict(self), 0
            self.clear()
        words = text.replace("\n", " ").split(" ")  # other white space is left to the tokenizer
        return b"".join(map(self.__getitem__, words))

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST:
            return self._encode(word)
        got = self.older.get(word)
        if got is None:
            got = self._encode(word)
        self[word] = got
        self.held += ENTRY_BYTES + 4 * len(word) + len(got)
        return got

    def _encode(self, word: str) -> bytes:
        core = word.rstrip(TAIL)
        if len(core) < len(word) and core.isalnum() and _ends_plainly(core):  # punctuation is a token of its own after a letter or digit
            return self[core] + self[word[len(core) :]]
        if word.isalpha() and "\u03a3" not in word and unicodedata.is_normalized("NFC", word):
            # letters alone are one piece for the model; only case is normalised
            low = word.lower()
            if low != word:
                return self[low] if low.isalpha() else self._whole(word)
            piece = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
        return self._whole(word)

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
