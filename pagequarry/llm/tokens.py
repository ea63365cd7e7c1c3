"""Words and their hashes, shared by the operators. Runs inside tasks on one document at a time."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str | None) -> list[bytes]:
    """Runs of anything but U+0020 and U+0009 to U+000D, as UTF-8. Null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_EDGE = b".,;:!?\"'()[]{}<>*&%$#@~`|/\\_-+="


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII marks at their edges."""
    if not text:
        return []
    return [w for w in (x.strip(_EDGE) for x in text.lower().encode("utf-8", "surrogatepass").split()) if w]


def lower_ascii(text: str | None) -> str | None:
    """Lower-cases A-Z and nothing else."""
    return text.translate(_LOWER) if text else text


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def word_hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items), dtype=np.uint64, count=len(items))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def rolling(hashes: np.ndarray, offsets: range | tuple[int, ...]) -> np.ndarray:
    """Polynomial hash modulo 2^64 of the words at ``offsets`` from every position that has them all.

    With consecutive offsets it is the Rabin-Karp hash of each window; with gaps the seed hash of a mask.
    """
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for o in offsets:
        out *= _BASE
        out += hashes[o:o + n]
    return mix(out)
