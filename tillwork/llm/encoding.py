"""Token ids of whole texts, encoding each distinct stretch between spaces only once.

A space that begins a run of white space always begins a new pre-token, for patterns that glue one
space to the word after it as well as for those that drop white space. A text may be cut there, and
likewise at a line break that begins such a run, and the ids of the stretches joined: the result is
that of the library for the whole text. Stretches recur, so few calls of the library remain.
"""

from __future__ import annotations

import os
import re
from array import array

#: White space besides the space, in any reading (fixed values).
OTHER_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BEFORE_SPACE = tuple(c + " " for c in " " + OTHER_SPACES if c.isascii())
BEFORE_SPACE_WIDE = tuple(c + " " for c in OTHER_SPACES if not c.isascii())
SPACE_AFTER_WORD = re.compile(rf"(?<=[^ {OTHER_SPACES}]) ")
#: Letters whose lower case is one letter as well.
LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: Marks that end a word.
MARKS = frozenset(".,;:!?")
#: Inside a stretch: a letter before a mark (not an apostrophe, which may belong to a contraction),
#: any word before a line break, a single line break before a letter.
CUT = re.compile(
    rf"(?<=[{LETTER}])(?=[!-&(-/:-@[-`{{}}~])|(?<=[^ {OTHER_SPACES}])(?=\n)"
    rf"|(?<=[^ {OTHER_SPACES}]\n)(?=[{LETTER}])"
)
#: Stretches, and pieces of them, remembered by a task before it starts afresh.
MEMORY = 600_000


def byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others in order from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Ids of a piece, asked of the library once."""

    def __init__(self, path: str, lower_case: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.lower_case = lower_case

    def __missing__(self, piece: str) -> bytes:
        word = piece[1:] if piece[:1] == " " else piece
        # A plain word is one pre-token and needs the model alone.
        if word.isalpha() and (not self.lower_case or max(word) < "\u0100"):
            if word.isascii():  # its letters stand for themselves
                plain = word.lower() if self.lower_case else piece.replace(" ", self.letters[32])
            else:
                bytes_of = (word.lower() if self.lower_case else piece).encode()
                plain = bytes_of.decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(plain)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        found = self[piece] = array("I", ids).tobytes()
        return found


class _Stretches(dict):
    """Ids of a stretch that follows a space."""

    def __init__(self, pieces: _Pieces, lead: str):
        self.pieces = pieces
        self.lead = lead

    def __missing__(self, stretch: str) -> bytes:
        pieces = self.pieces
        if stretch.isalpha():  # nowhere to cut
            found = pieces[self.lead + stretch]
        elif stretch[-1:] in MARKS and stretch[:-1].isalpha() and stretch.isascii():
            found = pieces[self.lead + stretch[:-1]] + pieces[stretch[-1]]
        else:
            found = b"".join(map(pieces.__getitem__, CUT.split(self.lead + stretch)))
        self[stretch] = found
        return found


class Encoder:
    """``encode(text)``: the ids of a text as little-endian unsigned 32-bit integers.

    ``glues_space``: the tokenizer keeps a space as the start of the word after it. Otherwise it
    drops white space and lower-cases.
    """

    def __init__(self, path: str, glues_space: bool, memory: int = MEMORY):
        self.pieces = _Pieces(path, not glues_space)
        self.stretches = _Stretches(self.pieces, " " if glues_space else "")
        self.memory = memory

    def split(self, text: str) -> list[str]:
        if any(c in text for c in BEFORE_SPACE) or (
            not text.isascii() and any(c in text for c in BEFORE_SPACE_WIDE)
        ):
            return SPACE_AFTER_WORD.split(text)
        return text.split(" ")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self.stretches) > self.memory:
            self.stretches.clear()
        if len(self.pieces) > self.memory:
            self.pieces.clear()
        first, *rest = self.split(text)
        head = self.pieces.tokenizer.encode(first, add_special_tokens=False).ids
        return array("I", head).tobytes() + b"".join(map(self.stretches.__getitem__, rest))
