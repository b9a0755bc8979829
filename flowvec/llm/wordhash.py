"""64-bit hashes of the words of many texts at once, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Texts that are hashed together, in bytes.
GROUP_BYTES = 1_000_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
BASE = np.uint64(0x2545F4914F6CDD1D)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads them."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


# One spread number per byte value.
BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64."""
    known = _POWERS.get(str(base))
    if known is None or len(known) < n:
        known = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 2 * GROUP_BYTES), base, np.uint64)]))
        if n <= 2 * GROUP_BYTES:
            _POWERS[str(base)] = known
    return known[:n]


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in order, the first word of each text (one more at the end), and where words start and
    end in the texts joined by one blank.

    A word's hash is the sum of its bytes' numbers times powers of a base by
    place, from one running sum over all texts, moved to place 0 and mixed.
    """
    joined = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    blank = BLANK[joined]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    sums = np.cumsum(BYTE[joined] * powers(BASE, len(joined)), dtype=np.uint64)
    # sums[i] counts byte i; a byte lies before every word.
    raw = (sums[ends - 1] - sums[starts - 1]) * powers(INVERSE, len(joined))[starts]
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return mix(raw ^ mix((ends - starts).astype(np.uint64))), np.searchsorted(starts, begin), starts, ends


def in_groups(texts: Iterable[bytes | None], size: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    """Texts in groups of about ``size`` bytes; a longer text is a group of its own."""
    held, n = [], 0
    for text in texts:
        held.append(text or b"")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held
