"""Token ids of whole texts, word by word.

The tokenizer never joins anything across a space or a line feed, so the ids of a text are those of its words in
order, and a word's ids are looked up once a worker. Words of plain Latin letters, digits and signs skip the
tokenizer's normalisation, which leaves them as they are but for their case.
"""

import re

import numpy as np
import tokenizers
from tokenizers import Tokenizer

#: Words kept at once by a worker, and the bytes of the longest that is kept.
MOST_WORDS, LONGEST = 250_000, 64
PLAIN = re.compile("[!-~¡-¬®-ÿ]+")
# The pre-tokenizer's pattern, for the characters of PLAIN in lower case.
LETTER, NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be printed, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Little-endian 32-bit ids by word. Misses are encoded and kept."""

    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            letters = self.letters
            found = np.array([x.id for x in self.whole.model.tokenize("".join([letters[b] for b in part.encode()]))], "<u4").tobytes()
            if len(self.parts) >= MOST_WORDS:
                self.parts.clear()
            self.parts[part] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if len(word) > LONGEST:
            return self.encode(text)
        ids = b"".join([self.part(p) for p in PARTS.findall(text.lower())]) if PLAIN.fullmatch(text) else self.encode(text)
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = ids
        return ids


def document_ids(path: str):
    """A function from text to ids, as bytes. What it has looked up stays with the worker, for its later tasks."""
    kept = tokenizers.__dict__.setdefault("_words_by_file", {})
    words = kept.get(path)
    if words is None:
        words = kept[path] = Words(path)
        words.special = [t.content for t in words.whole.get_added_tokens_decoder().values()]

    def ids(text: str) -> bytes:
        if any(s in text for s in words.special):
            return words.encode(text)
        return b"".join(map(words.__getitem__, text.encode().replace(b"\n", b" ").split(b" ")))

    return ids
