"""Words of whole texts as numpy arrays: places and 64-bit hashes.

One pass over the UTF-8 bytes per segment, no Python work per word. A word's
hash is a polynomial over random byte values modulo 2**64, taken from prefix
sums and moved to position 0 by the inverse power, then mixed; so equal words
have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np

from goldvein.llm.common import worker_state

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15


def _tables() -> dict[str, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    values = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
    other = np.ones(256, bool)
    other[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
    return {"lower": lower, "space": space, "other": other, "values": values, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(tables: dict[str, np.ndarray], n: int) -> None:
    if len(tables["up"]) < n:
        size = max(n, 2 * len(tables["up"]), 1 << 14)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            tables[name] = np.cumprod(p, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | bytes, lower: bool = True, letters: bool = False,
             prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(first byte, byte after the last, hash) of every word of the UTF-8 text,
    and for each of ``prefixes`` the hash of its first so many bytes (0 if it
    has no more than these). With ``letters``, words are runs of letters
    (ASCII letters and all bytes beyond) instead of runs of visible characters."""
    t = worker_state("word-tables", _tables)
    blanks = t["other"] if letters else t["space"]
    data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data):  # cut only at white space
            stop = np.flatnonzero(blanks[data[end:end + SEGMENT]])
            end = min(len(data), end + (int(stop[0]) if len(stop) else SEGMENT))
            if len(stop):
                break
        b = data[at:end]
        if lower:
            b = t["lower"][b]
        blank = np.empty(len(b) + 2, bool)
        blank[0] = blank[-1] = True
        blank[1:-1] = blanks[b]
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        _powers(t, len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(t["values"][b] * t["up"][:len(b)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * t["down"][starts]
        heads = []
        for n in prefixes:
            x = mix((sums[np.minimum(starts + n, ends)] - sums[starts]) * t["down"][starts] + np.uint64(n << 32))
            heads.append(np.where(ends - starts > n, x, np.uint64(0)))
        parts.append((starts + at, ends + at, mix(h + (ends - starts).astype(np.uint64)), *heads))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return (none, none, *[np.zeros(0, np.uint64)] * (1 + len(prefixes)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]


def windows(h: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``n`` words; empty if there are fewer."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    t = worker_state("word-tables", _tables)
    _powers(t, len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h + np.uint64(seed)) * t["up"][:len(h)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * t["down"][:len(h) - n + 1])
