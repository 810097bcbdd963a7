"""Token ids of whole texts, by a public tokenizer and with a bounded memory of pieces seen before.

The tokenizer never joins text across a single space or line end between two visible characters, nor a letter or digit
with a sign behind it, so a text is the sequence of its pieces, and each distinct piece is encoded once per worker: a
word once, whatever signs follow it. Texts with other white space, or with the
name of a special token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import public_tokenizers
import regex
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = 250_000  # remembered in each of two generations; two workers of an executor hold four

# runs of white space, or any but a space or line end, join what stands beside them
_RUNS = ("  ", " \n", "\n ", "\n\n", "<|")
_OTHER_SPACE = re.compile("[\x00\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN = re.compile(r"[\n\x20-\x7e¡-ſ]+")
# a sign behind a letter or digit; the sign comes first, since a search for it is quick
_SIGN = re.compile(r"[!-/:-@\[-`{-~](?<=[0-9A-Za-zÀ-ÖØ-öø-ſ].)")


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte in vocabularies of byte-level tokenizers."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(shown))
    return [letters[b] for b in range(256)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.letters = {i: c for i, c in enumerate(_byte_letters())}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, key: str) -> bytes:
        """Ids of a remembered piece: a line end or a null character in front stands for itself or for nothing."""
        if key.isalpha() and (key.isascii() or _PLAIN.fullmatch(key)):  # a word behind a space: the pattern cuts nothing
            shown = (" " + key).encode().decode("latin-1").translate(self.letters)
            return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        text = key if key[0] == "\n" else key[1:] if key[0] == "\x00" else " " + key
        if not _PLAIN.fullmatch(text):
            return self.whole(text)
        out = array("I")
        for part in self.pattern.findall(text):
            shown = part.encode().decode("latin-1").translate(self.letters)
            out.extend([token.id for token in self.model.tokenize(shown)])
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if text[0] in " \n" or text[-1] in " \n" or any(run in text for run in _RUNS) or _OTHER_SPACE.search(text):
            return self.whole(text)
        pieces = _SIGN.sub(" \x00\\g<0>", text.replace("\n", " \n")).split(" ")
        pieces[0] = "\x00" + pieces[0]
        ids = list(map(self.young.get, pieces))
        if None in ids:
            ids = [self._remembered(key) if found is None else found for key, found in zip(pieces, ids)]
        if len(self.young) > PIECES:
            self.old, self.young = self.young, {}
        return b"".join(ids)

    def _remembered(self, key: str) -> bytes:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            self.young[key] = found = self._piece(key) if found is None else found
        return found


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(vocabulary)
