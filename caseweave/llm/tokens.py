"""Token ids of whole texts with a tokenizer file, fast by remembering pieces.

A text is cut where the tokenizer is sure to cut it as well, so the ids of a text
are the ids of its pieces in a row and a frequent piece is encoded only once.
"""

from __future__ import annotations

import os
import re
from array import array

from caseweave.llm.workers import kept

#: Pieces remembered per worker in each of two generations, and the longest one that is.
REMEMBERED = 300_000
LONGEST = 48
#: What tokenizers and Python see differently, or what may be a special token.
_UNSURE = "\x1c\x1d\x1e\x1f"
_ODD_BLANKS = "\t\x0b\x0c\r\x85\xa0"
_WIDE_BLANKS = re.compile("[  -     　]")
_GAPS = re.compile(r" ?[^\s]+|\s+(?!\S)|\s+")
_MARKS = ".,;:!?"
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _letter(c: str) -> str:
    """Bytes that are printable in Latin-1 stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in c.encode())


#: How a byte-level vocabulary writes the two bytes of the letters above.
_BYTES = {c: _letter(chr(c)) for c in range(0xC0, 0x100)}


def _only_simple_blanks(text: str) -> bool:
    """Whether every gap is a blank or a line feed, or two of them that are two tokens."""
    if "  " in text or " \n" in text or "\n\n\n" in text or "\n\n " in text or text[-2:].isspace():
        return False
    if any(c in text for c in _ODD_BLANKS):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _WIDE_BLANKS.search(text)
    return True


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = REMEMBERED if remembered is None else remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Without a blank in front of a word in its vocabulary, white space only separates.
        self.spaced = self.tokenizer.token_to_id("Ġthe") is not None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_marks: dict[str, bytes] = {}
        self.feed = self._whole("\n")

    def shrink(self) -> None:
        """Between tasks only the current generation stays."""
        self.older.clear()

    def encode(self, text: str) -> bytes:
        if "<|" in text or any(c in text for c in _UNSURE):
            return self._whole(text)
        if not self.spaced:
            return self._joined(text.replace("\n", " ").split(" "), self._word)
        if _only_simple_blanks(text):
            # Each piece but the first follows a blank, unless it starts with its line feed.
            first, *others = text.replace("\n", " \n").split(" ")
            return self._whole(first) + self._joined(others, self._after_blank)
        return b"".join([self._gap(p) for p in _GAPS.findall(text)])

    def _gap(self, piece: str) -> bytes:
        if piece[0] != " " or piece.isspace():
            return self._whole(piece)
        return self.known.get(piece[1:]) or self._after_blank(piece[1:])

    def _joined(self, pieces: list[str], fresh) -> bytes:
        parts = list(map(self.known.get, pieces))
        parts.append(None)
        at = parts.index(None)
        while at < len(pieces):
            parts[at] = fresh(pieces[at])
            at = parts.index(None, at + 1)
        parts.pop()
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, {}
        return b"".join(parts)

    def _whole(self, text: str) -> bytes:
        """By the tokenizer itself."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() if text else b""

    def _word(self, piece: str) -> bytes:
        found = self.known.get(piece) or self.older.get(piece)
        if found is None:
            word = piece.rstrip(_MARKS)
            if not (word.isascii() and word.isalpha() or _PLAIN.fullmatch(word)):
                found = self._whole(piece)
            else:
                found = self._plain(word.lower(), "", piece[len(word) :])
        if len(piece) <= LONGEST:
            self.known[piece] = found
        return found

    def _after_blank(self, piece: str) -> bytes:
        found = self.known.get(piece) or self.older.get(piece)
        if found is None:
            feed = piece[:1] == "\n"
            word = (piece[1:] if feed else piece).rstrip(_MARKS)
            if not (word.isascii() and word.isalpha() or _PLAIN.fullmatch(word)):
                found = self.feed + self._whole(piece[1:]) if feed else self._whole(" " + piece)
            elif feed:
                found = self.feed + self._plain(word, "", piece[1 + len(word) :])
            else:
                found = self._plain(word, "Ġ", piece[len(word) :])
        if len(piece) <= LONGEST:
            self.known[piece] = found
        return found

    def _plain(self, word: str, blank: str, marks: str) -> bytes:
        """One word and its punctuation: the model's own input, without the tokenizer's other steps."""
        found = None
        if marks and (blank or not self.spaced):  # then the word alone is a piece of its own
            found = self.known.get(word) or self.older.get(word)
        if found is None:
            symbols = blank + (word if word.isascii() else word.translate(_BYTES))
            found = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        return found + self._run_of_marks(marks) if marks else found

    def _run_of_marks(self, marks: str) -> bytes:
        if marks not in self.known_marks:
            if len(self.known_marks) > 10_000:
                self.known_marks.clear()
            self.known_marks[marks] = array("I", [t.id for t in self.model.tokenize(marks)]).tobytes()
        return self.known_marks[marks]


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """One per worker process."""
    return kept(("encoder", path, remembered), lambda: Encoder(path, remembered))
