"""Tokens and shingles of many texts at once, in numpy, over the bytes of texts: the tokens of ``text.tokens(text.normal_form(...))``."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# --- Fixed values: what Java's patterns take for white space and for word characters where they go by Unicode.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
HYPHEN = re.compile(rf"-[{SPACE}]*\n[{SPACE}]*")
LINE_END = re.compile(rb"-[\t-\r ]*\n")
WORD = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Me", "Mc", "Nd", "Pc"}
#: The only letters beyond ASCII whose lower case is in it; of others the case doesn't matter, as no token has them.
TO_ASCII = "\u0130\u212a"
OTHER_WORD = re.compile(r"[\u200c\u200d\u24b6-\u24e9\U0001f130-\U0001f149\U0001f150-\U0001f169\U0001f170-\U0001f189]")
BLANK, LETTERS, DIGITS = 32, slice(97, 123), slice(48, 58)
FOLD = np.full(256, BLANK, np.uint8)
FOLD[LETTERS] = FOLD[65:91] = np.arange(97, 123)
FOLD[DIGITS] = np.arange(48, 58)
FOLD, BLANKS = FOLD.tobytes(), np.flatnonzero(FOLD == BLANK).astype(np.uint8).tobytes()
#: Bits that a packed column has at most.
WORD_BITS = 63


def slices(batch: pa.RecordBatch, texts: list[int], most: int):
    """Parts of a batch with some ``most`` bytes of these columns of texts, one row at least."""
    ends, i = np.cumsum(sum(pc.binary_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts)), 0
    while i < batch.num_rows:
        stop = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, side="right")))
        yield batch.slice(i, stop - i)
        i = stop


def _word(c: str) -> bool:
    return unicodedata.category(c) in WORD or bool(OTHER_WORD.match(c))


def _joined(text: str) -> str:
    """Words hyphenated over a line end joined. A character that a join has used isn't used by the next."""
    out, last, free = [], 0, 0
    for m in HYPHEN.finditer(text):
        if m.start() > free and m.end() < len(text) and _word(text[m.start() - 1]) and _word(text[m.end()]):
            out.append(text[last : m.start()])
            last, free = m.end(), m.end() + 1
    return "".join([*out, text[last:]])


def folded(text: bytes | None, normalise: bool = True) -> bytes:
    """A text as its tokens need it; capitals may be left. Most texts are given back as they are."""
    text = text or b""
    if (plain := text.isascii()) and not LINE_END.search(text):
        return text
    low = was = text.decode("utf-8", "replace")
    if not plain:
        low = unicodedata.normalize("NFKC", low) if normalise else low
        low = low.lower() if any(c in low for c in TO_ASCII) else low
    out = text if low == was else low.encode()
    return _joined(low).encode() if LINE_END.search(out) else out


class Tokens:
    """The tokens of texts, one text after another: ``words`` (Arrow strings), ``row`` (number of the text), ``codes`` (below ``distinct``, the same for equal tokens),
    and whether each has a letter, and a digit and two characters; that is found once for each distinct token.
    """

    def __init__(self, texts: list[bytes | None], normalise: bool = True):
        parts = [folded(t, normalise) for t in texts]
        data = b" ".join([b"", *parts, b""])
        inside = np.frombuffer(data.translate(FOLD), np.uint8) != BLANK
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # a blank is first and last
        begin, size = edges[0::2], edges[1::2] - edges[0::2]
        chars = np.frombuffer(data.translate(FOLD, BLANKS), np.uint8)
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        self.words = pa.StringArray.from_buffers(len(size), pa.py_buffer(at), pa.py_buffer(chars))
        last = np.searchsorted(begin, np.cumsum([len(p) + 1 for p in parts], dtype=np.int64))
        self.row = np.repeat(np.arange(len(parts)), np.diff(last, prepend=0))
        found = self.words.dictionary_encode()
        self.codes, self.distinct = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
        ends, chars = (np.frombuffer(b, kind) for b, kind in zip(found.dictionary.buffers()[1:], (np.int32, np.uint8), strict=True)) if self.distinct else (at, chars)
        ends = ends[: self.distinct + 1]
        has = lambda low, high: np.logical_or.reduceat((chars >= low) & (chars < high), ends[:-1]) if self.distinct else np.zeros(0, bool)
        self.letter = has(LETTERS.start, LETTERS.stop)[self.codes]
        self.numeral = (has(DIGITS.start, DIGITS.stop) & (np.diff(ends) >= 2))[self.codes]


def packed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """These columns of numbers from 0 in as few as hold them side by side: equal rows stay equal, and no others become so."""
    out, room = [], 0
    for c in columns:
        bits = int(c.max(initial=0)).bit_length()
        if bits > room:
            out.append(c)
            room = WORD_BITS - bits
        elif out:
            out[-1] = (out[-1] << bits) | c
            room -= bits
        else:
            out, room = [c], WORD_BITS
    return out


def ranked(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row of these columns, the same for equal rows and no others."""
    out = columns[0]
    for c in columns[1:]:
        out = np.unique(out * (int(c.max(initial=0)) + 1) + c, return_inverse=True)[1]
    return out.astype(np.uint64)


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """64 bits for each row of these columns; what is equal here is compared afterwards."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out + c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def sorted_by(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a key, and which of the keys in order but the first are the one before."""
    order = np.argsort(key)
    key = key[order]
    return order, key[1:] == key[:-1]


class Shingled:
    """The shingles of n letter tokens of sources and their targets, compared within each pair.

    ``row`` and ``at``: pair and place of every shingle, sources first; ``own``: how many are sources'; ``group``: equal shingles of a pair, for
    each of which ``pair``, ``in_source`` and ``in_target`` say where it is. Shingles are equal if their tokens are: hashes only sort them.
    """

    def __init__(self, sources: list[bytes | None], targets: list[bytes | None], n: int, normalise: bool = True):
        self.pairs, self.tokens = len(sources), Tokens([*sources, *targets], normalise)
        self.kept = np.flatnonzero(self.tokens.letter)
        codes, row = self.tokens.codes[self.kept], self.tokens.row[self.kept]
        self.size = np.bincount(row, minlength=2 * self.pairs)
        self.begin = np.cumsum(self.size) - self.size
        m = max(len(row) - n + 1, 0)
        first = np.flatnonzero(row[:m] == row[n - 1 :])
        self.own = int(np.searchsorted(row[first], self.pairs))
        columns = [row[:m] % max(self.pairs, 1), *(codes[i : m + i] for i in range(n))]
        narrow = [c[first] for c in packed(columns)]
        self.at, self.row = first - self.begin[row[first]], columns[0][first]
        key = hashed(narrow) if len(narrow) > 1 else narrow[0]
        order, same = sorted_by(key)
        if len(narrow) > 1 and not all((c[1:] == c[:-1])[same].all() for c in (c[order] for c in narrow)):
            order, same = sorted_by(ranked([c[first] for c in columns]))
        new = np.r_[True, ~same][: len(order)]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.pair = self.row[order[new]]
        self.in_source, self.in_target = (np.zeros(len(self.pair), bool) for _ in range(2))
        self.in_source[self.group[: self.own]] = self.in_target[self.group[self.own :]] = True

    def per_pair(self, groups: np.ndarray) -> np.ndarray:
        return np.bincount(self.pair[groups], minlength=self.pairs)

    def numerals(self) -> tuple[np.ndarray, np.ndarray]:
        """How many numerals each source has, and how many of them its target has too."""
        t, wide = self.tokens, max(self.tokens.distinct, 1)
        row, code = t.row[t.numeral], t.codes[t.numeral]
        own = row < self.pairs
        source, target = (np.unique((row[side] % max(self.pairs, 1)) * wide + code[side]) for side in (own, ~own))
        return tuple(np.bincount(x // wide, minlength=self.pairs) for x in (source, np.intersect1d(source, target, assume_unique=True)))

    def lacking(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place) of the shingles of sources that their targets lack, in order."""
        out = np.flatnonzero(~self.in_target[self.group[: self.own]])
        return self.row[out], self.at[out]

    def said(self, pair: np.ndarray, at: np.ndarray, tokens: int, most: int) -> pa.Array:
        """So many letter tokens of these sources from these places on, ``most`` characters of them; all of them in one step."""
        size = np.minimum(tokens, self.size[pair] - at)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        place = np.arange(ends[-1]) + np.repeat(self.begin[pair] + at - ends[:-1], size)
        lists = pa.ListArray.from_arrays(pa.array(ends), self.tokens.words.take(pa.array(self.kept[place])))
        return pc.utf8_slice_codeunits(pc.binary_join(lists, " "), 0, most)
