"""Encoding of texts by way of their distinct pieces.

Byte-level BPE encodes each match of its split pattern by itself, so a text may
be cut wherever a match must end, and each piece encoded alone, with the same
ids as the whole text. Such places are: in front of a space that a non-space
follows (of a run of white space all but the last character form one match,
and that last one, if it is a space, opens the next), on both sides of a single
line end between non-spaces, and in front of a full stop or comma that follows
a letter or digit. Most pieces are words that come again and again; a bounded
dictionary of the worker remembers them, and only new pieces reach the encoder.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

RARE = re.compile(r"[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\0]").search
LOOSE = re.compile(r"[.,](?<![A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff].)").search
CUT = re.compile(r"(?<=.)(?= [^\s\x85])", re.S)


def pieces_of(text: str) -> list[str]:
    if ("  " in text or "\n " in text or " \n" in text or "\n\n" in text or text[:1].isspace() or text[-1:].isspace()
            or LOOSE(text) or RARE(text)):  # one of these stands elsewhere than described
        return CUT.split(text)
    return (text.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,")).split("\0")


class ChunkEncoder:
    """``encode(pieces)`` returns, per piece, its ids as little-endian uint32
    bytes. Pieces of at most ``longest`` characters are remembered, in a memory
    of about ``most`` bytes (beyond it the memory starts afresh; results do not
    depend on it); longer ones, such as text without spaces, are encoded where
    they stand and forgotten with their text."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 128 << 20, longest: int = 64):
        self.encode, self.most, self.longest = encode, most, longest
        self.known: dict[str, bytes] = {}
        self.held = 0

    def __call__(self, texts: Iterable[str], budget: int = 2_000_000) -> Iterator[bytes]:
        """Ids of each text, as bytes; texts are taken in groups of about ``budget`` characters."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= budget:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        known, cut = self.known, [pieces_of(t) for t in texts]
        new = list(set().union(*cut).difference(known))
        short, long = [p for p in new if len(p) <= self.longest], [p for p in new if len(p) > self.longest]
        if short:
            ids = self.encode(short)
            known.update(zip(short, ids))
            self.held += sum(map(len, ids)) + sum(map(len, short)) + 250 * len(short)  # two objects and a place in the table
        passing = dict(zip(long, self.encode(long))) if long else {}
        for pieces in cut:
            yield b"".join([known[p] if p in known else passing[p] for p in pieces]) if long else b"".join(map(known.__getitem__, pieces))
