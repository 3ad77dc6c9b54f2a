"""Byte-level BPE piece by piece: texts are cut where no token can cross, and each distinct piece is encoded once.

A byte-level vocabulary with the usual splitting pattern never joins a word to
what stands before the blank in front of it. So the ids of a text are the ids of
its pieces, one after the other, and a worker keeps those of pieces it has seen.

A block of texts is split at blanks and its distinct pieces are numbered by Arrow;
only these pass through Python. The ids of all texts are then gathered at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as Unicode defines it, and as the splitting patterns use it.
SPACE = "\t-\r \x85\xa0  -     　"
_COARSE = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_CUT = re.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")
LONG = 1 << 20  # characters cut at once
KNOWN = 600_000  # pieces a worker keeps, some 130 MB
BLOCK = 2 << 20  # characters whose new pieces are encoded together


def stretches(text: str) -> Iterator[str]:
    """The text in stretches of about ``LONG`` characters, cut before a single blank between words."""
    start = 0
    while len(text) - start > LONG:
        cut = _CUT.search(text, start + LONG)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class PieceEncoder:
    """Encodes texts by pieces. ``encode`` gives the ids of new pieces, each as unsigned 32-bit integers in bytes."""

    def __init__(self, encode: Callable[[Sequence[str]], Sequence[bytes]], known: int = KNOWN):
        self.encode, self.known = encode, known
        self.after_blank: dict[str, bytes] = {}  # the piece with a blank before it
        self.as_is: dict[str, bytes] = {}

    def __call__(self, texts: Sequence[str]) -> Iterator[bytes]:
        block: list[list[str]] = []
        size = 0
        for text in texts:
            block.append(list(stretches(text)))
            size += len(text)
            if size >= BLOCK:
                yield from self._block(block)
                block, size = [], 0
        if block:
            yield from self._block(block)

    def _block(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts, each given in stretches."""
        if len(self.after_blank) + len(self.as_is) > self.known:
            # Frequent pieces came early: the oldest two thirds are worth more than the rest.
            self.after_blank = dict(islice(self.after_blank.items(), len(self.after_blank) * 2 // 3))
            self.as_is = dict(islice(self.as_is.items(), len(self.as_is) * 2 // 3))
        cut = [s for text in texts for s in text]
        words = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        starts = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = starts[:-1]
        led = np.ones(len(which), dtype=bool)  # has a blank before it
        led[first] = False
        # A piece that is empty or has white space at its ends; an empty one before the first blank does no harm.
        known = list(map(self.after_blank.get, distinct))
        uneven = np.array([k is None and (not p or p.strip() != p) for k, p in zip(known, distinct)], dtype=bool)
        empty = np.array([not p for p in distinct], dtype=bool)
        harm = np.where(led, uneven[which], uneven[which] & ~empty[which])
        coarse = np.logical_or.reduceat(harm, first)
        used = np.zeros(len(distinct), dtype=bool)
        used[which[led & ~np.repeat(coarse, np.diff(starts))]] = True

        blank = [p for p, k, u in zip(distinct, known, used.tolist()) if u and k is None]
        cuts = {i: _COARSE.findall(cut[i]) for i in np.flatnonzero(coarse).tolist()}
        heads = {i: distinct[which[first[i]]] for i in np.flatnonzero(~coarse).tolist()}
        whole = dict.fromkeys([*heads.values(), *(p for pieces in cuts.values() for p in pieces)])
        whole = [p for p in whole if p and p not in self.as_is]
        if blank or whole:
            found = iter(self.encode([*(" " + p for p in blank), *whole]))
            self.after_blank.update(zip(blank, found))
            self.as_is.update(zip(whole, found))

        ids = [self.after_blank[p] if u else b"" for p, u in zip(distinct, used.tolist())]
        gathered, ends = _gathered(ids, which, led, starts)
        own = self.as_is.__getitem__
        done = iter([b"".join(map(own, cuts[i])) if i in cuts else
                     (own(heads[i]) if heads[i] else b"") + gathered[ends[i] * 4:ends[i + 1] * 4].tobytes()
                     for i in range(len(cut))])
        return [b"".join([next(done) for _ in text]) for text in texts]


def _gathered(ids: list[bytes], which: np.ndarray, led: np.ndarray, starts: np.ndarray):
    """The ids of all pieces that follow a blank, one after the other, and where those of each stretch begin."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begins = np.cumsum(sizes) - sizes
    lengths = np.where(led, sizes[which], 0)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    from_ = np.repeat(begins[which] - ends[:-1], lengths) + np.arange(ends[-1])
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    return flat[from_].view(np.uint8), ends[starts].tolist()
