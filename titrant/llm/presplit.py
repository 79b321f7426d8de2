"""Splitting texts into the pieces that a byte-pair tokenizer's merges work within, a slice at a time.

Texts of U+0000 to U+00FF only are split with table look-ups over their bytes; any other text goes, whole, through the
tokenizer library's own normaliser and pre-tokenizer. Both give the same pieces.

Edge cases: null and empty texts have no pieces; a slice without a byte has none. Texts are split whole, however long; a
piece may be as long as its text. Repeated rows have the same pieces.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from .bytewords import OWN, Slice

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_BLANK = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}


def _class(code: int) -> int:
    if code in _BLANK:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(code))[0], OTHER)


_CLASS = np.array([_class(c) for c in range(256)], np.uint8)
#: After English contractions' apostrophe.
_TAILS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def latin_lower(buf: np.ndarray) -> np.ndarray:
    """Lower case of a text of U+0000 to U+00FF."""
    out = buf.copy()
    out[(buf >= 65) & (buf <= 90)] += 32
    second = np.flatnonzero(buf == 0xC3) + 1
    up = second[(buf[second] >= 0x80) & (buf[second] <= 0x9E) & (buf[second] != 0x97)]
    out[up] += 32
    return out


def classes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte's character, and whether the byte begins a character."""
    kind = _CLASS[np.minimum(buf, 127)]
    lead = np.flatnonzero(buf >= 0xC0)
    code = ((buf[lead] & 3) << 6) | (buf[lead + 1] & 63)
    kind[lead] = kind[lead + 1] = _CLASS[code]
    begins = (buf & 0xC0) != 0x80
    return kind, begins


def narrow_rows(part: Slice) -> np.ndarray:
    """Which texts have no character beyond U+00FF."""
    return part.per_row(part.buf > 0xC3) == 0


def _contractions(buf: np.ndarray, kind: np.ndarray, first: np.ndarray, row_end: np.ndarray) -> None:
    """``'s 't 're 've 'm 'll 'd`` where a piece may begin at the apostrophe are pieces of their own; ``first`` is mended in place."""
    for p in np.flatnonzero(buf == 39):
        if not first[p]:
            continue
        tail = buf[p + 1 : min(p + 3, row_end[p])].tobytes()
        size = next((len(t) for t in _TAILS if tail.startswith(t)), 0)
        if not size:
            continue
        q = p + 1 + size
        first[p + 1 : q] = False
        # what follows begins a piece unless the text ends here
        if q < len(buf) and q < row_end[p]:
            first[q] = True


def split(part: Slice, buf: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first places of the pieces of narrow texts.

    ``spaced``: pieces take one blank before them and blanks are pieces (byte-level BPE); otherwise blanks only divide,
    and every digit is a piece.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(part.n + 1, np.int64)
    kind, begins = classes(buf)
    edge = np.zeros(n, bool)
    edge[part.offs[:-1][np.diff(part.offs) > 0]] = True
    row_end = np.repeat(part.offs[1:], np.diff(part.offs))
    before = np.concatenate([[255], kind[:-1]])
    first = (kind != before) | edge
    if spaced:
        # the last blank of a run before other characters: U+0020 goes with them, another is a piece of its own
        last_blank = np.flatnonzero((kind == SPACE) & begins)
        width = np.where(buf[last_blank] >= 0xC0, 2, 1)
        nxt = last_blank + width
        ok = nxt < row_end[last_blank]
        last_blank, nxt = last_blank[ok], nxt[ok]
        ok = kind[nxt] != SPACE
        last_blank, nxt = last_blank[ok], nxt[ok]
        first[last_blank] = True
        joined = buf[last_blank] == 32
        first[nxt[joined]] = False
    else:
        first[(kind == NUMBER) & begins] = True
    if (buf == 39).any():
        _contractions(buf, kind, first, row_end)
    starts = np.flatnonzero(first)
    ends = np.concatenate([starts[1:], [n]])
    if not spaced:
        solid = kind[starts] != SPACE
        starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(starts, part.offs)


class Pieces:
    """Distinct pieces of a tokenizer, each encoded once and then looked up by its hash of 62 bits, in bases drawn by the process.

    The store is a cache only: when it is full it is emptied. What a hash finds there counts only if its bytes are those
    of the piece. ``encode`` maps distinct pieces to entries.
    """

    LIMIT = 700_000
    LIMIT_BYTES = 64 << 20

    def __init__(self, encode: Callable[[list[bytes]], list]):
        self.encode = encode
        self._empty()

    def _empty(self) -> None:
        self.known: list = []
        self.pieces: list[bytes] = []
        self.size = 0
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending, and where each one's entry stands

    def entries(self, part: Slice, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list, np.ndarray]:
        """Entries of the distinct pieces, and for each piece the place of its entry."""
        view = Slice(part.lo, part.hi, buf, part.offs, part.null)
        found, at, back = np.unique(view.span_hash(view.prefix_hash(bases=OWN), starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > self.LIMIT or self.size > self.LIMIT_BYTES:
            self._empty()
        raw = buf.tobytes()
        here = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        place = np.searchsorted(self.hashes, found)
        there = np.zeros(len(found), bool)
        inside = place < len(self.hashes)
        there[inside] = self.hashes[place[inside]] == found[inside]
        new = np.flatnonzero(~there)
        if len(new):
            fresh = [here[i] for i in new.tolist()]
            added = self.encode(fresh)
            self.places = np.insert(self.places, place[new], len(self.known) + np.arange(len(new)))
            self.hashes = np.insert(self.hashes, place[new], found[new])
            self.known += added
            self.pieces += fresh
            self.size += sum(map(len, fresh))
            place = np.searchsorted(self.hashes, found)
        at_entry = self.places[place].tolist()
        pieces, known = self.pieces, self.known
        out = [known[k] for k in at_entry]
        other = [i for i, k in enumerate(at_entry) if pieces[k] != here[i]]
        for i, entry in zip(other, self.encode([here[i] for i in other]) if other else (), strict=True):
            out[i] = entry
        return out, back
