"""Token ids of whole texts by a public tokenizer, with words encoded once per worker.

A byte-level BPE with word ends encodes each word by itself, so the ids of a text are
those of its words in order. Texts of plain Latin letters, digits and ASCII punctuation
go through a table of known words; its model encodes new ones. Any other text (and any
that may hold a special token) goes to the tokenizers library word by word or whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence

import numpy as np

from weirflow.llm.words import WordTable, per_worker

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work

# Characters for which NFC, lower case and the word pattern are beyond doubt.
_OTHER = re.compile(r"[^ \n\t\r!-~À-ÖØ-įı-ſ]")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


def _byte_characters() -> dict[int, str]:
    """How a byte-level BPE writes plain characters that are not ASCII: two shifted bytes."""
    whole = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in whole]
    shown = {b: chr(b) for b in whole} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}


class Encoder:
    """Ids of texts for the tokenizer file ``path``: NFC, lower case, BPE with word ends."""

    def __init__(self, path: str, limit: int = 400_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.model.tokenize
        self.characters = _byte_characters()
        self.table = WordTable(self._word, "<u4", limit=limit)

    def batch(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text; a null text has none."""
        plain = [t if t and "<|" not in t and not _OTHER.search(t) else None for t in texts]
        ids, bounds = self.table.batch(plain)
        return [
            ids[bounds[i] : bounds[i + 1]] if plain[i] or not text else self._library(text)
            for i, text in enumerate(texts)
        ]

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._piece(word)
        pieces = _PIECES.findall(word)
        if len(pieces) == 2 and len(pieces[0]) > 1:  # a word with a mark behind it
            known = self.table.known.get(pieces[0])
            return (known or self._piece(pieces[0])) + self._piece(pieces[1])
        return b"".join(map(self._piece, pieces))

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.characters)
        return array("I", [t.id for t in self.split(piece)]).tobytes()

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return per_worker(f"encoder {path}", lambda: Encoder(path))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
