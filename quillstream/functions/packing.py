"""Sentence packing over a word list: which word ranges become chunks."""

from __future__ import annotations

from collections.abc import Iterator

from .text import SENTENCE_END


def check_window(size: int, overlap: int) -> None:
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size={size}, overlap={overlap}")


def sentence_stops(words: list[str]) -> Iterator[int]:
    """Word positions just behind each sentence; the last word always closes one."""
    last = len(words) - 1
    for at, word in enumerate(words):
        if word[-1] in SENTENCE_END or at == last:
            yield at + 1


def chunk_spans(words: list[str], size: int, overlap: int) -> list[tuple[int, int]]:
    """Word ranges of the chunks, in order.

    Sentences are added while they fit in `size` words. A new chunk starts with the last `overlap` words of the one
    before and is not measured again, so it may reach `size + overlap`. A sentence longer than `size` is cut into
    windows of its own, with no overlap to its neighbours.
    """
    spans: list[tuple[int, int]] = []
    start = end = 0
    for stop in sentence_stops(words):
        if stop - end > size:
            if end > start:
                spans.append((start, end))
            spans.extend((at, min(at + size, stop)) for at in range(end, stop, size - overlap))
            start = stop
        elif stop - start > size:
            spans.append((start, end))
            start = max(start, end - overlap)
        end = stop
    if end > start:
        spans.append((start, end))
    return spans
