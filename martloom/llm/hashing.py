"""Words of whole texts as 64-bit hashes, computed over byte arrays."""

from __future__ import annotations

import numpy as np

SEGMENT = 2 << 20  # bytes hashed at a time
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = _powers[name] = np.cumprod(held)
    return held[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, whatever its place."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _MULT, len(data)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def segments(texts: list[bytes], blank: np.ndarray) -> list[tuple[int, bytes]]:
    """(row, bytes) parts, none much over SEGMENT, cut only at blank bytes."""
    out = []
    for row, text in enumerate(texts):
        while len(text) > SEGMENT:
            near = np.flatnonzero(blank[np.frombuffer(text, np.uint8, SEGMENT)])
            if len(near):
                cut = int(near[-1]) + 1
            else:  # one long word: up to the first blank behind it
                rest = np.flatnonzero(blank[np.frombuffer(text, np.uint8)])
                cut = int(rest[0]) + 1 if len(rest) else len(text)
            out.append((row, text[:cut]))
            text = text[cut:]
        out.append((row, text))
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased, in order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if not held:
            return
        data = np.frombuffer(b" ".join(b for _, b in held), np.uint8)
        edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        hashes = span_hashes(data, starts, ends)
        bounds = np.cumsum([0] + [len(b) + 1 for _, b in held])
        cuts = np.searchsorted(starts, bounds)
        for (row, _), a, b in zip(held, cuts[:-1], cuts[1:], strict=True):
            found[row].append(hashes[a:b])
        held, size = [], 0

    for row, part in segments([t.encode("utf-8", "surrogatepass").lower() for t in texts], _SPACE):
        if size + len(part) > SEGMENT:
            flush()
        held.append((row, part))
        size += len(part)
    flush()
    return [f[0] if len(f) == 1 else np.concatenate(f) for f in found]


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; fewer words make one run; none make none."""
    n = len(words)
    if n == 0:
        return words
    take = min(n, width)
    factor = mix(np.arange(1, take + 1, dtype=np.uint64) + np.uint64(1000 * take))
    run = np.zeros(n - take + 1, np.uint64)
    for k in range(take):
        run += words[k : n - take + 1 + k] * (factor[k] | np.uint64(1))
    return np.unique(mix(run))
