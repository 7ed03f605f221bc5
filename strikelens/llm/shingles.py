"""Sets of word shingles as 64-bit hashes, of many texts at a time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))

#: Bytes that a word is read in at a time, which bytes are white space, and what keeps the first so many bytes of a piece.
_PIECE = 8
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(_PIECE + 1)], np.uint64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``hashes``, changed in place so that every bit depends on all of them."""
    hashes ^= hashes >> np.uint64(33)
    hashes *= MIX[0]
    hashes ^= hashes >> np.uint64(33)
    hashes *= MIX[1]
    hashes ^= hashes >> np.uint64(33)
    return hashes


def _words(texts: Sequence[bytes]) -> tuple[np.ndarray, list[int]]:
    """Hashes of the words of all ``texts``, one text after the other, and where each text begins, with the end of the last.

    A word is hashed in pieces of eight bytes, each mixed with its place, which are added up with the length.
    """
    # white space around every text, so that no word goes on in the next one and a piece can be read at each word's end
    data = b" ".join([b"", *texts, b" " * (_PIECE + 1)]).lower()
    is_space = _IS_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(is_space[1:] != is_space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    piece_at = np.ndarray(len(data) - _PIECE + 1, np.dtype("<u8"), data, strides=(1,))
    hashes = _mixed((piece_at[starts] & _FIRST[np.minimum(lengths, _PIECE)]) + PRIME)
    long = np.flatnonzero(lengths > _PIECE)
    if len(long):
        more = (lengths[long] - 1) // _PIECE
        begin = np.cumsum(more) - more
        place = np.arange(more.sum()) - np.repeat(begin, more) + 1
        at = np.repeat(starts[long], more) + _PIECE * place
        left = np.minimum(np.repeat(ends[long], more) - at, _PIECE)
        pieces = _mixed((piece_at[at] & _FIRST[left]) + PRIME * (place + 1).astype(np.uint64))
        hashes[long] += np.add.reduceat(pieces, begin)
    hashes += lengths.astype(np.uint64)
    begins = np.cumsum([0] + [len(text) + 1 for text in texts])
    return _mixed(hashes), np.searchsorted(starts, begins).tolist()


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """The hash of every ``words`` words in a row."""
    n = len(hashes) - words + 1
    found = hashes[:n].copy()
    for k in range(1, words):
        found *= PRIME
        found += hashes[k : n + k]
    found += np.uint64(words)
    return _mixed(found).view(np.int64)


class Shingler:
    """The sets of texts: sorted 64-bit hashes of the distinct shingles of each. A text of fewer words is one shingle."""

    def __init__(self, words: int):
        self.words = words

    def set(self, text: bytes | None) -> np.ndarray:
        return self.sets([text])[0]

    def sets(self, texts: Sequence[bytes | None]) -> list[np.ndarray]:
        """All words are hashed at once, so memory follows the sum of the texts, several times."""
        hashes, begins = _words([text or b"" for text in texts])
        every = _shingles(hashes, self.words) if len(hashes) >= self.words else hashes[:0].view(np.int64)
        found = []
        for start, end in zip(begins, begins[1:]):
            if 0 < end - start < self.words:
                found.append(_shingles(hashes[start:end], end - start))
                continue
            own = np.sort(every[start : max(start, end - self.words + 1)])
            fresh = own[1:] != own[:-1]
            found.append(own if fresh.all() else np.concatenate((own[:1], own[1:][fresh])))
        return found
