"""Token ids of whole texts."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

from tokenizers import Tokenizer

from viewtide.llm.base import kept

# Words and parts of words whose ids a worker remembers, and how long one may be (bytes or characters): at most some 250 MB.
MEMORY = 1_500_000
LONG = 64


# How the file's tokenizer splits lower-case text, and the same for words of visible ASCII characters and
# letters up to U+017F that are one character in lower case. Normalising leaves those as they are.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9]+")
LATIN = re.compile(r"(?!.*<\|)[!-~À-ÖØ-öø-įı-ſ]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible in Latin-1, else one from U+0100 on, in order."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


BYTES = byte_characters()


class Remembered(dict):
    """Ids by word, worked out where a word is met first."""

    def __init__(self, encode: Callable):
        self.encode, self.long = encode, []

    def __missing__(self, word):
        ids = self[word] = self.encode(word)
        if len(word) > LONG:
            self.long.append(word)
        return ids

    def forget_long(self) -> None:
        for word in self.long:
            del self[word]
        self.long.clear()


class WordTokenizer:
    """A tokenizer that drops white space, so that a text's ids are those of its words in a row.

    Ids are little-endian, two bytes each where the vocabulary allows it, else four.
    """

    def __init__(self, path: str):
        # Spark runs one task on a core; the library's own threads would take the others' cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.kind, self.code = ("<u2", "H") if small else ("<u4", "I")
        # Words differ by marks and capitals more than their parts do.
        self.words, self.parts = Remembered(self._encoded), Remembered(self._part)
        # Normalising and splitting takes most of the library's time. Words of Latin letters need neither.
        file = json.loads(self.tokenizer.to_str())
        splitters = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.plain = splitters[0].get("pattern") == {"Regex": PARTS} and [s["type"] for s in splitters] == ["Split", "ByteLevel"]

    def _part(self, part: str) -> bytes:
        """The ids of a part of Latin letters or other characters in lower case."""
        if not part.isascii():
            part = "".join([BYTES[b] for b in part.encode()])
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(part)]).tobytes()

    def _encoded(self, word: bytes) -> bytes:
        if self.plain and word.isalpha():
            return self.parts[word.lower().decode()]
        text = word.decode("utf-8", "replace")
        if self.plain and LATIN.fullmatch(text):
            return b"".join([self.parts[part] for part in LATIN_PARTS.findall(text.lower())])
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def batch(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text in UTF-8; none for a null text. Each word that is new is encoded once."""
        if len(self.words) + len(self.parts) > MEMORY:
            self.words.clear()
            self.parts.clear()
        ids = [b"".join(map(self.words.__getitem__, (t or b"").split())) for t in texts]
        self.words.forget_long()
        self.parts.forget_long()
        return ids


@kept
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker and file."""
    return WordTokenizer(path)
