"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from starblend.llm.common import STEP_BYTES, runs, steps, text_word_hashes, word_hashes


def shingle_sets(texts: list[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word windows, A-Z lower-cased.

    Fewer words are one window; a text without words has the empty set.
    """
    for lo, hi in steps(texts):
        if hi - lo == 1 and len(texts[lo]) > 2 * STEP_BYTES:
            yield np.unique(runs(next(text_word_hashes(texts[lo:hi])), width))
            continue
        hashes, first = word_hashes(texts[lo:hi])
        windows = runs(hashes, width)
        for i in range(hi - lo):
            a, b = first[i], first[i + 1]
            yield np.unique(windows[a : b - width + 1] if b - a >= width else runs(hashes[a:b], width))
