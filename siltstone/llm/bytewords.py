"""Words and shingles of many texts at once, in numpy, over the bytes of an Arrow column.

A text is lower-cased A-Z and split at ``[\\x20\\x09-\\x0D]+``. Words are hashed from one running
sum over the bytes: with ``C`` the running sum of ``byte * P**i`` modulo 2**64, a word from s to e
has ``(C[e] - C[s]) * P**-s``, so no word is copied. Arrays are sized for chunks of about
CHUNK bytes; one longer text makes a longer chunk, and no text is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

P = 0x9E3779B97F4A7C15
P_INV = pow(P, -1, 1 << 64)
CHUNK = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words for bags of words: ASCII letters and digits, and every byte outside ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i up to n, kept for the next chunk; a rare long text doesn't stay."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        made = []
        for base in (P, P_INV):
            row = np.full(size + 1, base, dtype=np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        _POWERS[size] = tuple(made)
    return _POWERS[size]


def chunks(texts: pa.Array, chunk: int = CHUNK):
    """(first row, bytes, offsets from 0) of about ``chunk`` bytes each; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + chunk, side="right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``inside`` holds, cut at the ends of texts, and each one's text."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < n]
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    back = offsets[1:-1] - 1
    back = back[back >= 0]
    last[back] |= inside[back]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of (lower-cased) bytes."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def shingles(words: np.ndarray, owner: np.ndarray, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row and the text of each; a shorter text has its whole sequence as one."""
    counts = np.bincount(owner, minlength=n_texts)
    begin = np.cumsum(counts) - counts
    total = np.zeros(len(words), dtype=np.uint64)
    full = max(0, len(words) - width + 1)
    for i in range(width):
        total[:full] = mix(total[:full] * np.uint64(P) + words[i : i + full] + np.uint64(i + 1))
    place = np.arange(len(words)) - begin[owner]
    keep = place + width <= counts[owner]
    out, own = total[keep], owner[keep]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        rest = np.zeros(len(short), dtype=np.uint64)
        for i in range(width - 1):
            has = counts[short] > i
            rest[has] = mix(rest[has] * np.uint64(P) + words[begin[short[has]] + i] + np.uint64(i + 1))
        # the length keeps a short text apart from every shingle
        rest = mix(rest + counts[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        out, own = np.concatenate([out, rest]), np.concatenate([own, short])
    return out, own


def sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one after another, and where each text's begin."""
    n = len(offsets) - 1
    low = LOWER[data]
    starts, ends, owner = spans(low, offsets, ~SPACE[low])
    values, own = shingles(hashed(low, starts, ends), owner, n, width)
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    values, own = values[new], own[new]
    at = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.bincount(own, minlength=n), out=at[1:])
    return values, at
