"""Words of a long text in bounded slices."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of text that are split into words at a time.
SLICE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(text: bytes, carry: int, size: int = SLICE) -> Iterator[tuple[list[bytes], int]]:
    """Words between ASCII white space, in slices of about ``size`` bytes.

    Each slice is led by the last ``carry`` words before it, and told how many they are, so that runs of up to
    ``carry + 1`` words are seen whole: a run is new if it ends behind the led words.
    """
    if len(text) <= size:
        yield text.split(), 0
        return
    start, tail = 0, []
    while start < len(text):
        cut = _GAP.search(text, min(start + size, len(text)))
        end = cut.start() if cut else len(text)
        words = tail + text[start:end].split()
        yield words, len(tail)
        tail, start = words[len(words) - carry :] if len(words) > carry else words, end
