"""Recursive character splitting of one text, as spans of it.

Pieces keep their separator in front, so neighbouring pieces are adjacent and a chunk is always one
span of the text; only its ends are stripped. Working on offsets copies each chunk once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pagequarry.config import SEPARATORS


def _cuts(text: str, lo: int, hi: int, sep: str) -> list[int]:
    """Offsets that bound the pieces of text[lo:hi], each piece starting with ``sep`` but the first."""
    bounds = [lo]
    at = text.find(sep, lo, hi)
    while at != -1:
        if at > lo:
            bounds.append(at)
        at = text.find(sep, at + len(sep), hi)
    bounds.append(hi)
    return bounds


def _windows(bounds: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Widest runs of adjacent pieces that fit ``size``, each starting within ``overlap`` of the last end."""
    first = 0
    for i in range(len(bounds) - 1):
        lo, hi = bounds[i], bounds[i + 1]
        if hi - bounds[first] > size and i > first:
            yield bounds[first], lo
            while first < i and (lo - bounds[first] > overlap or hi - bounds[first] > size):
                first += 1
    yield bounds[first], bounds[-1]


def _character_windows(lo: int, hi: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    stride = max(1, size - overlap)
    while hi - lo > size:
        yield lo, lo + size
        lo += stride
    yield lo, hi


def _spans(text: str, lo: int, hi: int, seps: tuple[str, ...], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    depth = next((d for d, s in enumerate(seps) if s == "" or text.find(s, lo, hi) != -1), None)
    if depth is None:
        yield lo, hi
        return
    if seps[depth] == "":
        yield from _character_windows(lo, hi, size, overlap)
        return
    run: list[int] = []
    bounds = _cuts(text, lo, hi, seps[depth])
    for a, b in zip(bounds, bounds[1:]):
        if b - a < size:
            run.append(a)
            continue
        if run:
            yield from _windows(run + [a], size, overlap)
            run = []
        yield from _spans(text, a, b, seps[depth + 1:], size, overlap)
    if run:
        yield from _windows(run + [hi], size, overlap)


def split_text(text: str | None, size: int = 1000, overlap: int = 200,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    if not text or not text.strip():
        return []
    chunks = (text[a:b].strip() for a, b in _spans(text, 0, len(text), separators, size, overlap))
    return [c for c in chunks if c]
