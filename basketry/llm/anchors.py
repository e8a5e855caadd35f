"""Content-defined anchors of long byte strings.

A window is WIDTH bytes; its anchor is the place of the least hash of GRAM
bytes inside it (the leftmost of equals). The anchor depends on the window's
bytes alone, so equal windows have their anchor at the same place, whatever stands
around them. Neighbouring windows mostly share an anchor: they make a segment.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from basketry.llm.tokens import POWERS, U64, mix, prefix_hashes

WIDTH, GRAM = 400, 64
#: Windows handled in one pass over a long text.
PASS = 1 << 20
_PLACE = U64((1 << 24) - 1)


class Segments(NamedTuple):
    """Windows [start, start + count) whose anchor is the same place."""

    start: np.ndarray
    count: np.ndarray
    offset: np.ndarray  # of the anchor behind the start
    lead: np.ndarray  # the anchor's first eight bytes
    anchor: np.ndarray  # hash of the anchor's gram
    content: np.ndarray  # hash of all bytes of the segment's windows


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place, as a number that sorts like them (but for the sign)."""
    out = np.zeros(len(at), U64)
    for j in range(8):
        out = out << U64(8) | data[at + j].astype(U64)
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * POWERS.upto(len(prefix))[1][start])


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every run of ``span`` values, by minima that run forward and backward in blocks."""
    n = len(values) - span + 1
    padded = np.full(-(-len(values) // span) * span, np.iinfo(np.uint64).max, U64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, span)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[span - 1:span - 1 + n])


def _part(data: np.ndarray) -> Segments:
    windows = len(data) - WIDTH + 1
    prefix = prefix_hashes(data)
    grams = len(data) - GRAM + 1
    at = np.arange(grams)
    hashes = substring_hashes(prefix, at, at + GRAM)
    least = _least((hashes & ~_PLACE) | at.astype(U64), WIDTH - GRAM + 1)[:windows] & _PLACE
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.concatenate([first, [windows]]))
    place = least[first].astype(np.int64)
    # the place of the anchor is part of the content: equal segments have it in the same place
    content = substring_hashes(prefix, first, first + count + WIDTH - 1)
    return Segments(first, count, place - first, leading(data, place), hashes[place], content)


def segments(data: bytes) -> Segments:
    """Segments of all windows of a text, in order; none for a text shorter than a window."""
    whole = np.frombuffer(data, np.uint8)
    windows = len(whole) - WIDTH + 1
    parts = []
    for at in range(0, max(windows, 0), PASS):
        part = _part(whole[at:min(at + PASS, windows) + WIDTH - 1])
        parts.append(part._replace(start=part.start + at))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Segments(empty, empty, empty, *[empty.astype(U64)] * 3)
    return Segments(*map(np.concatenate, zip(*parts)))
