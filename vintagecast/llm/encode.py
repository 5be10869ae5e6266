"""Token ids by the tokenizers library, each distinct word encoded once.

A text is cut at blanks, where these tokenizers always start a new word, so
the ids of a piece don't hang on what stands around it.  A piece made of
letters is one word to the tokenizer and goes straight to the library's model;
any other piece goes through the whole tokenizer.  Ids of short pieces are
kept (two generations of bounded size).  Texts in which such cuts aren't safe
(runs of blanks, strings of special tokens) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Pieces kept in each of two generations, and the longest piece kept.
KEPT, LONGEST = 600_000, 64
#: Letters up to U+024F, without the one (U+0130) whose lower case is two characters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: White space to Python but not to the tokenizers.
_ODD = re.compile("[\x1c-\x1f]")
_WORD = re.compile(rf"[{_LETTERS}]+")


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the
    others for code points from 256 on, in ascending order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ALPHABET = _byte_chars()


class _Kept(dict):
    """Ids (as bytes) by piece; a piece not here comes from the generation
    before or is encoded now, ASCII letters by the model at once."""

    def __init__(self, encode, tokens, before: dict):
        self.encode, self.tokens, self.before = encode, tokens, before

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            if piece.isalpha() and piece.isascii():
                ids = array("I", [t.id for t in self.tokens(piece)]).tobytes()
            else:
                ids = self.encode(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: Word tokenizers drop white space and case; byte-level ones glue one blank to the next word.
        self.drops_space = getattr(self.tokenizer.model, "end_of_word_suffix", None) == "</w>"
        self.lead = "" if self.drops_space else " "
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens = self.tokenizer.model.tokenize
        #: Marks at a word's end (ASCII, alone, repeated, or after one of the first four) with their ids.
        marks = ".,;:!?)\"#$%&*-|"
        runs = {a * n for a in marks for n in (1, 2, 3)} | {a + b * n for a in marks[:4] for b in marks for n in (1, 2, 3)}
        self.tails = {t: self.whole(t) for t in sorted(runs)}
        self.line = self.whole("\n")
        self.forget()

    def forget(self) -> None:
        """Drops the kept pieces: a worker that lives on needs their memory for other work."""
        self._fresh({}, {})

    def _fresh(self, led: dict, bare: dict) -> None:
        #: Pieces after a blank; pieces at the start of a text or line.
        tokens, blank = self.tokens, _ALPHABET[0x20]
        if self.lead:
            self.led = _Kept(lambda p: self._piece(p, " "), lambda p: tokens(blank + p), led)
            self.bare = _Kept(lambda p: self._piece(p, ""), tokens, bare)
        else:
            self.led = self.bare = _Kept(lambda p: self._piece(p, ""), lambda p: tokens(p.lower()), led)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a word of letters up to U+024F."""
        if self.drops_space:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [t.id for t in self.tokens((_ALPHABET[0x20] if lead else "") + word)]).tobytes()

    def _piece(self, piece: str, lead: str) -> bytes:
        m = _WORD.match(piece)
        if m and m.end() == len(piece):
            return self._word(piece, lead)
        if m and (tail := self.tails.get(piece[m.end() :])) is not None:
            return (self.led if lead else self.bare)[m[0]] + tail
        if self.lead and "\n" in piece:  # a lone line end between words is a word of its own
            lines = piece.split("\n")
            if all(x.split() == [x] for x in lines):
                return (self.led if lead else self.bare)[lines[0]] + b"".join(self.line + self.bare[x] for x in lines[1:])
        return self.whole(lead + piece)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text, as ``encode(text, add_special_tokens=False)`` gives them."""
        if not text:
            return np.zeros(0, np.uint32)
        if any(s in text for s in self.special) or (self.lead and "  " in text) or _ODD.search(text):
            return np.frombuffer(self.whole(text), np.uint32)
        if len(self.led) > KEPT or len(self.bare) > KEPT:
            self._fresh(dict(self.led), dict(self.bare))
        if self.drops_space:
            return np.frombuffer(b"".join(map(self.led.__getitem__, text.split())), np.uint32)
        first, *rest = text.split(" ")
        return np.frombuffer((self.bare[first] if first else b"") + b"".join(map(self.led.__getitem__, rest)), np.uint32)


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary file and Python worker."""
    return WordEncoder(path)
