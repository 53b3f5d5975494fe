"""Words as several operators compare them: lower case, without punctuation around them."""

from __future__ import annotations

import numpy as np

from parcelflow.llm import kernel

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Signs taken off each end of a word at most.
_TRIMS = 6


def bare_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words without ASCII punctuation around them; a word of nothing else keeps one sign."""
    for _ in range(_TRIMS):
        trim = _PUNCT[data[ends - 1]] & (ends - starts > 1)
        if not trim.any():
            break
        ends = ends - trim
    for _ in range(_TRIMS):
        trim = _PUNCT[data[starts]] & (ends - starts > 1)
        if not trim.any():
            break
        starts = starts + trim
    return starts, ends


def bare_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words without punctuation around them, and the first word of each text."""
    starts, ends, firsts = kernel.words(data, offsets)
    starts, ends = bare_spans(data, starts, ends)
    return kernel.word_hashes(data, starts, ends, lower=True), firsts
