"""Words of many texts at once, as numpy arrays over one byte buffer."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 18


def not_space() -> np.ndarray:
    """Byte class of words ``[^\\x20\\x09-\\x0D]+``."""
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return word


def letters_and_digits() -> np.ndarray:
    """Byte class of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of text whose A-Z are lower-cased."""
    word = np.zeros(256, bool)
    word[0x30:0x3A] = True
    word[0x61:0x7B] = True
    word[0x80:] = True
    return word


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each followed by a line end, and where each begins."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), begins


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def owner(begins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the text that each start lies in."""
    return np.searchsorted(begins, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int = 1) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SpanHash:
    """64-bit hashes of spans of a buffer by differences of a rolling sum, a segment at a time."""

    def __init__(self, seed: int = 1):
        self.values = byte_values(seed)
        self.up = powers(BASE, SEGMENT)
        self.down = powers(INVERSE, SEGMENT)

    def __call__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``starts`` and ``ends`` ascend and do not overlap."""
        out = np.empty(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            origin = int(starts[first])
            last = int(np.searchsorted(ends, origin + SEGMENT - 1, side="right"))
            if last <= first:  # one span longer than a segment
                out[first] = self._long(buffer[origin : int(ends[first])])
                first += 1
                continue
            a, b = starts[first:last] - origin, ends[first:last] - origin
            part = self.values[buffer[origin : origin + int(b[-1])]] * self.up[: int(b[-1])]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
            out[first:last] = (sums[b] - sums[a]) * self.down[a]
            first = last
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def _long(self, data: np.ndarray) -> np.uint64:
        total, factor = 0, 1
        step = pow(BASE, SEGMENT, 1 << 64)
        for at in range(0, len(data), SEGMENT):
            piece = data[at : at + SEGMENT]
            total += factor * int((self.values[piece] * self.up[: len(piece)]).sum(dtype=np.uint64))
            factor = factor * step % (1 << 64)
        return np.uint64(total % (1 << 64))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which have occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    seen, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    seen[order[1:]] = same
    later[order[1:]] = same
    seen[order[:-1]] |= same
    return seen, later


def gram_hashes(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` consecutive words inside one text, and the word it begins at."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    count = len(hashes) - n + 1
    at = np.flatnonzero(doc[:count] == doc[n - 1 :])
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        total = total * np.uint64(BASE) + hashes[at + k]
    return mix(total + doc[at].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), at


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside any of the windows of ``n`` words that begin at ``at``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0
