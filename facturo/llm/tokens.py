"""Token ids of whole texts, word by word, with the ``tokenizers`` library.

The tokenizer lower-cases, cuts a text into words by one pattern and runs its
merges inside each word, so the ids of a text are those of its words in order
(checked for the loaded file by a test). Words repeat, so their ids are kept
in a table of bounded size per Python worker. Texts of plain Latin letters,
digits, ASCII signs and blanks are cut into words here and each new word is
given to the library's model; of any other text, each blank-separated chunk
goes through the library's whole chain.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np

# The word pattern of the tokenizer file, for plain lower-case text.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
# Blanks, and characters for which the library's normaliser only lowers case.
_PLAIN = re.compile(r"[\x20-\x7e\t\n\r\x0b\x0cÀ-ÖØ-öø-ÿ]+")
# Signs side by side make one word; where there are none, a blank before a sign changes nothing.
_SIGNS = re.compile(r"[^\sa-zß-öø-ÿ0-9]{2}")
_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")

#: Words whose ids one worker keeps, about 200 bytes each.
MAX_WORDS = 300_000


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE's printable character of each byte: printable Latin-1 stands for itself, the rest follow from 256."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Plain lower-case chunk between blanks -> bytes of its ids; fills itself, and starts anew when full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype(np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16)
        self.code = "I" if self.dtype.itemsize == 4 else "H"
        self.chars = _byte_chars()

    def _word(self, word: str) -> bytes:
        text = word if word.isascii() else word.encode().decode("latin-1").translate(self.chars)
        return array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        words = _WORDS.findall(chunk)
        ids = self._word(chunk) if len(words) == 1 else b"".join(map(self.__getitem__, words))
        if len(self) >= MAX_WORDS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text (null: none) as bytes of an array of ``dtype``."""
        if not text:
            return b""
        if _PLAIN.fullmatch(text) and "<|" not in text:
            text = text.lower()
            if _SIGNS.search(text):
                return b"".join(map(self.__getitem__, _WORDS.findall(text)))
            return b"".join(map(self.__getitem__, text.replace(",", " ,").replace(".", " .").split()))
        return b"".join(self._chunk(c) for c in _BLANKS.split(text) if c)

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return self[chunk.lower()]
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=self.dtype).tobytes()


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The worker's encoder for a tokenizer file; kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def default_tokenizer() -> str:
    """Path of the installed word-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
