"""Encoding of whole texts with the tokenizers library, piece by piece and remembered.

Both vocabularies cut a text into pretokens before any merge, and there is always
a cut at a space between two other characters, at a line break between two others, and
between a letter and the marks after it. A text is therefore encoded in such pieces, and each worker
remembers the ids of those it has met. The result is that of encoding the whole
text; texts in which white space stands in runs or at an end are encoded whole when
the vocabulary keeps white space.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np

#: Pieces a worker remembers, in two generations; longer ones are not remembered. Both affect time only.
REMEMBERED = 400_000
LONGEST = 48
#: Marks that may end a piece; none of them can begin a contraction.
MARKS = ".,!?;:*#$%&|)"
#: White space in runs, beside a line break, or of any other kind.
RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\v", "\f", "\0")
OTHER_SPACE = tuple(chr(c) for c in range(128, 0x3001) if chr(c).isspace())


def _alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it shows, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_ALPHABET = _alphabet()


def _ends_with_letter(piece: str | bytes) -> bool:
    """Whether the last character is a letter, and for bytes, which get small letters, one that stays a single letter."""
    if isinstance(piece, str):
        return piece[-1].isalpha()
    last = piece[-1:]
    if last < b"\x80":
        return last.isalpha()
    last = piece.decode()[-1]
    return last.isalpha() and last < "\u0250" and len(last.lower()) == 1


class Encoder:
    """Ids of texts as numpy arrays; control strings in a text are ordinary text."""

    def __init__(self, path: str):
        # one task has one core, and pools of threads would spin beside it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # white space is kept as long as a space has an id of its own
        self.keeps_space = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        # a mark that is a pretoken and an id of its own wherever it stands between pieces
        self.mark, self.between = ("\n", "\n") if self.keeps_space else ("7", " 7 ")
        self.mark_id = self.whole(self.mark)[0]
        # ids as the bytes of an array
        self.known: dict[str | bytes, bytes] = {}
        self.former: dict[str | bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _is_pretoken(self, piece: str) -> bool:
        if self.keeps_space:
            return (piece[1:] if piece[:1] == " " else piece).isalpha()
        # below this character, small letters are their own normal form
        return piece.isalpha() and piece.islower() and max(piece) < "\u0250"

    def _pieces(self, text: str) -> list | None:
        if not self.keeps_space:
            return text.encode().lower().split()
        if text[0].isspace() or text[-1].isspace() or any(run in text for run in RUNS):
            return None
        if not text.isascii() and any(space in text for space in OTHER_SPACE):
            return None
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def _learn(self, fresh: set) -> None:
        known, former = self.known, self.former
        as_text = str if self.keeps_space else bytes.decode
        marks = MARKS if self.keeps_space else MARKS.encode()
        parts: dict = {}
        missing: dict = {}
        for piece in fresh:
            ids = former.get(piece)
            if ids is not None:
                known[piece] = ids
                continue
            base = piece.rstrip(marks)
            if len(base) < len(piece) and base and _ends_with_letter(base):
                tail = piece[len(base) :]
                parts[piece] = base, tail
                for x in (base, tail):
                    if x not in known:
                        missing[x] = None
            else:
                missing[piece] = None
        mark = self.mark if self.keeps_space else self.mark.encode()
        plain = []
        tokenize = self.tokenizer.model.tokenize
        for x in missing:
            if self._is_pretoken(as_text(x)):
                # letters alone are one pretoken as they are, and go to the merges directly
                raw = x.encode() if self.keeps_space else x
                known[x] = array("I", [t.id for t in tokenize(raw.decode("latin-1").translate(_ALPHABET))]).tobytes()
            elif mark not in x:
                plain.append(x)
        # one call for all, cut at the mark: a result object for each piece costs more than its encoding
        ids = self.whole(self.between.join(map(as_text, plain)))
        ends = [-1, *np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
        if len(ends) == len(plain) + 1:
            joined = ids.tobytes()
            for x, start, end in zip(plain, ends, ends[1:]):
                known[x] = joined[4 * start + 4 : 4 * end]
        for x in missing:
            if x not in known:
                known[x] = self.whole(as_text(x)).tobytes()
        for piece, (base, tail) in parts.items():
            known[piece] = known[base] + known[tail]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Callers keep a batch to some hundred thousand characters."""
        cut = [self._pieces(text) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.former, self.known = self.known, {}
        known = self.known
        fresh = set(chain.from_iterable(pieces for pieces in cut if pieces)).difference(known)
        if fresh:
            self._learn(fresh)
        out = [
            self.whole(text) if pieces is None else np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.uint32)
            for text, pieces in zip(texts, cut)
        ]
        for piece in fresh:
            if len(piece) > LONGEST:
                known.pop(piece, None)
        return out

    def all(self, texts, characters: int = 200_000):
        """The ids of each of many texts, in order, with few texts in hand at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= characters:
                yield from self.batch(held)
                held, size = [], 0
        if held:
            yield from self.batch(held)

    def decode(self, ids) -> str:
        return self.tokenizer.decode(list(map(int, ids)), skip_special_tokens=False)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and vocabulary file."""
    return Encoder(path)


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
