"""Token ids of texts through a public tokenizer file, word by word with a bounded cache.

White space always separates tokens of this tokenizer, so the ids of a text are those of its words in a row. A run of
letters is always one unit of its model, and so is a run of marks, so a word of letters alone, or with marks at its
end, goes to the model directly; any other word goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import string
from array import array

CACHED_WORDS = 600_000
CHUNK_CHARS = 2_000_000
# fixed values: what Python's split takes for white space and the tokenizer doesn't
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\t-\r ]+")
# letters whose lower case and composed form do not depend on the library
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
MARKS = string.punctuation


def words_of(text: str) -> list[str]:
    """Runs without white space; pieces between tokens of any other kind may stay together."""
    return text.split() if NOT_SPACE.search(text) is None else [w for w in SPACE.split(text) if w]


def byte_characters() -> dict[int, str]:
    """The characters that stand for UTF-8 bytes in the model: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Words(dict):
    """Ids by word, as little-endian unsigned 32-bit numbers; a word that is asked for first is encoded.

    The cache is bounded: words that come when it is full are rare, and encoded each time.
    """

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.characters = byte_characters()
        self.words, self.cores, self.marks = Words(self.word), Words(self.core), Words(self.whole)

    def whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes() if word else b""

    def core(self, letters: str) -> bytes:
        """Of letters in lower case."""
        unit = letters if letters.isascii() else "".join([self.characters[b] for b in letters.encode()])
        return array("I", [t.id for t in self.model.tokenize(unit)]).tobytes()

    def word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS)
        lower = letters.lower()
        if letters and LETTERS(lower) is None:
            return self.whole(word)
        marks = word[len(letters) :]
        return (self.cores[lower] if letters else b"") + (self.marks[marks] if marks else b"")

    def close(self) -> None:
        """Let go of the caches, which refer back to this object, at the end of a task and not when Python notices."""
        for cache in (self.words, self.cores, self.marks):
            cache.clear()
            cache.encode = None

    def texts(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text, and `end`."""
        look, last = self.words.__getitem__, array("I", [end]).tobytes()
        return [b"".join(map(look, words_of(t))) + last for t in texts]


def chunks(texts: list[str], ids: list):
    """Runs of rows of at most `CHUNK_CHARS` characters, or one row."""
    size = start = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > CHUNK_CHARS:
            yield texts[start:k], ids[start:k]
            size, start = 0, k
        size += len(text)
    if texts:
        yield texts[start:], ids[start:]
