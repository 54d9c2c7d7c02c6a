"""Ids of whole texts under a lower-casing BPE vocabulary with word ends.

The vocabulary file splits texts at white space and never merges across it, so a text's ids
are those of its words in a row, and a word met before need not be encoded again.
"""

from __future__ import annotations

import re
import struct

from carestar.llm.common import Remembered, give_back

# Words of these characters alone are lower-cased and split here; all others go through the
# library. Latin letters with accents in one code point are in normal form already.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# Python's split() takes these for white space; the vocabulary's pattern does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 up."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in prints]
    letters = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def open_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str) -> dict[str, int]:
    """Pre-tokens proven to be one token each: a vocabulary string with a word end is listed
    if, given alone, it stays one pre-token and the full encoder answers with its id only."""
    tokenizer = open_tokenizer(path)
    values = {letter: b for b, letter in enumerate(byte_letters())}
    listed = []
    for string, number in tokenizer.get_vocab(with_added_tokens=False).items():
        letters = string.removesuffix("</w>")
        if letters == string or any(c not in values for c in letters):
            continue
        try:
            text = bytes(values[c] for c in letters).decode()
        except UnicodeDecodeError:
            continue
        if _PLAIN.fullmatch(text) and _PIECE.findall(text) == [text]:
            listed.append((text, number))
    found = {}
    # Encodings are far larger than their ids, so few are held at a time, and the rest goes back:
    # the driver runs on long after this.
    for low in range(0, len(listed), 1_000):
        part = listed[low : low + 1_000]
        encoded = tokenizer.encode_batch([text for text, _ in part], add_special_tokens=False)
        found.update((text, n) for (text, n), e in zip(part, encoded, strict=True) if e.ids == [n])
    tokenizer = values = listed = part = encoded = None
    give_back()
    return found


class Encoder:
    """Ids and their number, word by word. A word of several pieces, or with capitals, is put
    together from its pieces, which are words themselves and remembered as such."""

    def __init__(self, path: str, whole: dict[str, int], most: int = 1 << 18):
        self.tokenizer = open_tokenizer(path)
        self.model = self.tokenizer.model
        self.whole = whole
        self.letters = byte_letters()
        self.counts = Remembered(self._count, most)
        self.packed = Remembered(self._pack, most)

    def _merge(self, piece: str) -> list[int]:
        spelled = "".join([self.letters[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(spelled)]

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, word: str) -> list[str] | None:
        if "<|" in word or not _PLAIN.fullmatch(word):
            return None
        return _PIECE.findall(word.lower())

    def _count(self, word: str) -> int:
        pieces = self._pieces(word)
        if pieces is None:
            return len(self._slow(word))
        if pieces != [word]:
            return sum([self.counts[p] for p in pieces])
        return 1 if word in self.whole else len(self._merge(word))

    def _pack(self, word: str) -> bytes:
        pieces = self._pieces(word)
        if pieces is None:
            ids = self._slow(word)
        elif pieces != [word]:
            return b"".join([self.packed[p] for p in pieces])
        else:
            n = self.whole.get(word)
            ids = self._merge(word) if n is None else [n]
        return struct.pack(f"<{len(ids)}I", *ids)

    def count(self, text: str) -> int:
        if any(c in text for c in _SEPARATORS):
            return len(self._slow(text))
        return sum(map(self.counts.__getitem__, text.split()))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(c in text for c in _SEPARATORS):
            ids = self._slow(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.packed.__getitem__, text.split()))
