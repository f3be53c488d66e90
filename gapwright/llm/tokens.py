"""Exact encoding with a public byte-level tokenizer, through a cache of space-separated pieces.

The pre-tokenizer never lets a token cross a single space between two characters that are no white
space (the space begins the next token), nor one or two line feeds there, so a text can be cut there.
New pieces are cut on by the pre-tokenizer's published pattern and go, many at a time, through the
tokenizers library's BPE model, set apart by two bytes that UTF-8 lacks and no merge has. Texts with
other white space next to a space are cut only where the rule holds. A text that holds an added token's
content goes whole through the library's own encode, which alone knows where the token begins and ends."""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from itertools import count, islice

import numpy as np

#: Pieces that a worker remembers; it starts anew beyond that.
CACHE_PIECES = 500_000
#: New pieces that one call of the model gets.
GROUP = 2_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_WHITE_ASCII = [c for c in _WHITE if c.isascii()]
#: The byte-level pre-tokenizer's published pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII characters that are neither letters, digits nor white space; the first letter past the Latin blocks.
_MARKS, _LATIN = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "\u0250"
#: Bytes 0xFF and 0xFE as the surrogates that encode to them: between pre-tokens, after a piece.
_APART, _END = "\udcff", "\udcfe"


def _byte_letters() -> np.ndarray:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.arange(256, dtype="<u2")
    rest = np.setdiff1d(letters, own)
    letters[rest] = 256 + np.arange(len(rest))
    return letters


def pieces_of(text: str) -> list[str]:
    """The text cut at its lone spaces. A piece stands for a space and itself; one with NUL (after a line feed, or first) has no space."""
    if "\0" in text:  # such a text is taken whole
        return ["\0" + text]
    white = [w for w in (_WHITE_ASCII if text.isascii() else _WHITE) if w in text]
    if "  " in text or text[:1] == " " or text[-1:] == " " or "\n " in text or " \n" in text or any(w + " " in text or " " + w in text for w in white):
        got = _CUT.split(text)
    elif "\n" in text and not white and "\n\n\n" not in text and text[-2:] != "\n\n":
        got = text.replace("\n", " \n\0").split(" ")
    else:
        got = text.split(" ")
    got[0] = "\0" + got[0]
    return got


class Encoder:
    def __init__(self, path: str):
        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        self.size = lib.get_vocab_size()
        self.model = Tokenizer(lib.model)  # without the pre-tokenizer
        self.lib, self.added = lib, [x.content for x in lib.get_added_tokens_decoder().values()]
        self.cut, self.letters = regex.compile(PATTERN).findall, _byte_letters()
        apart, end = (chr(self.letters[b]) for b in (0xFF, 0xFE))
        if any((apart in x or end in x) and len(x) > 1 for x in lib.get_vocab(with_added_tokens=False)):
            raise ValueError("a merge of the vocabulary has a byte that UTF-8 lacks")
        self.apart, self.end = lib.token_to_id(apart), lib.token_to_id(end)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = defaultdict(count().__next__)  # pieces by first use
        self.flat = array("H" if self.size <= 1 << 16 else "I")
        self.at = array("q", [0])

    def _learn(self, keys: list[str]) -> None:
        for k in range(0, len(keys), GROUP):
            spelt = []
            for key in keys[k : k + GROUP]:
                core = key.rstrip(_MARKS)
                if core.isalpha() and max(core) < _LATIN:  # letters, then marks that start nothing of their own
                    spelt.append(" " + core if len(core) == len(key) else f" {core}{_APART}{key[len(core):]}")
                else:
                    spelt.append(_APART.join(self.cut(key.replace("\0", "", 1) if key[:1] == "\0" or key[:2] == "\n\0" else " " + key)))
            raw = np.frombuffer((_END.join(spelt) + _END).encode("utf-8", "surrogateescape"), np.uint8)
            line = self.letters[raw].tobytes().decode("utf-16-le")
            ids = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int64)
            ids = ids[ids != self.apart]
            ends = np.flatnonzero(ids == self.end)
            self.at.frombytes((len(self.flat) + ends - np.arange(len(ends))).tobytes())
            self.flat.frombytes(ids[ids != self.end].astype(self.flat.typecode).tobytes())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (and the end)."""
        whole = [k for k, t in enumerate(texts) if any(x in t for x in self.added)]
        if not whole:
            return self._cached(texts)
        parts, sizes, last = [], [], 0
        for k in [*whole, len(texts)]:
            ids, at = self._cached(texts[last:k])
            parts.append(ids)
            sizes += np.diff(at).tolist()
            if k < len(texts):
                parts.append(np.array(self.lib.encode(texts[k], add_special_tokens=False).ids, ids.dtype))
                sizes.append(len(parts[-1]))
            last = k + 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def _cached(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.code) > CACHE_PIECES:
            self._clear()
        pieces: list[str] = []
        counts = [0]
        for t in texts:
            pieces += pieces_of(t)
            counts.append(len(pieces))
        known = len(self.code)
        codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        self._learn(list(islice(reversed(self.code), len(self.code) - known))[::-1])
        at, flat = np.frombuffer(self.at, np.int64), np.frombuffer(self.flat, np.uint16 if self.flat.itemsize == 2 else np.uint32)
        size = at[codes + 1] - at[codes]
        ends = np.cumsum(size)
        where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[codes] - (ends - size), size)
        return flat[where], np.concatenate([[0], ends])[counts]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for the vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    """The public 50k byte-level vocabulary, where installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
