"""Windows of bytes grouped by content: equal windows get equal keys wherever they stand."""

from __future__ import annotations

import numpy as np

from tallywell.llm.common import BASE_INVERSE, U, mix, powers, running_hash

PLACE_BITS = 28
#: Texts beyond this many bytes are read in stretches that overlap by a window; it is below 2^PLACE_BITS.
STRETCH = 64 << 20


def window_hashes(running: np.ndarray, length: int) -> np.ndarray:
    """The hash of the ``length`` bytes from each place."""
    n = max(0, len(running) - length)
    return mix((running[length:] - running[:n]) * powers(BASE_INVERSE, n)[:n])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, U)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1: width - 1 + n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int, width: int, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place, number of windows, key) of runs of consecutive windows with one anchor.

    A window is ``length`` bytes of one text. Its anchor is the last of its stretches of ``width`` bytes with the
    least hash, and that hash is its key; so both depend on nothing but the window. Each window is in one run, and
    no two windows of a run are equal. More than ``stretch`` windows are read in stretches, and a run ends with its
    stretch.
    """
    n = len(data) - length + 1
    if n <= stretch:
        return _runs(data, offsets, length, width)
    found = []
    for low in range(0, n, stretch):
        part = data[low: low + stretch + length - 1]
        text, first, count, key = _runs(part, np.clip(offsets - low, 0, len(part)), length, width)
        found.append((np.searchsorted(offsets, first + low, "right") - 1, first + low, count, key))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros(0, U)
    hashes = window_hashes(running_hash(data), width)
    places = U((1 << PLACE_BITS) - 1) - np.arange(len(hashes), dtype=U)
    least = sliding_minimum((hashes >> U(PLACE_BITS) << U(PLACE_BITS)) | places, length - width + 1)
    inside = np.ones(n + 1, bool)
    inside[n] = False
    for end in offsets[1:].tolist():
        inside[max(0, end - length + 1): end] = False
    change = np.ones(n + 1, bool)
    change[1:n] = least[1:] != least[:-1]
    change[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n + 1))
    keep = inside[first]
    first, count = first[keep], count[keep]
    anchor = (U((1 << PLACE_BITS) - 1) - (least[first] & U((1 << PLACE_BITS) - 1))).astype(np.int64)
    return np.searchsorted(offsets, first, "right") - 1, first, count, hashes[anchor]
