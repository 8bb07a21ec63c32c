"""Words as units of byte-level BPE.

The pre-tokenizing pattern never joins characters across a blank that stands
before a word, so a text can be cut at its blanks (each word keeping the one
before it) and equal words encoded once. The only exception, a blank with
white space on its left and white space or the end on its right, is detected
and such a text is encoded as one unit. Words are cut, told apart and looked up
in Arrow, codes are rows of numpy arrays: Python sees only units not met lately.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A blank inside or at the end of a run of white space.
_RUN = rf"{_SPACE} (?:{_SPACE}|\z)"
#: Units longer than this are encoded but not remembered.
MEMO_CHARS = 64
#: Remembered units of a generation; there are two.
MEMO_UNITS = 450_000
#: Bytes of text whose units are told apart at once.
SLICE = 12 << 20
#: Units cut into pre-tokens at once.
CUT_UNITS = 1 << 17


class Codes:
    """Parts of one array of bytes: where each starts and its size."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.flat, self.starts, self.sizes = flat, starts, sizes

    @classmethod
    def of(cls, parts: list[bytes] | Codes) -> Codes:
        if isinstance(parts, Codes):
            return parts
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return cls(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes)

    @classmethod
    def joined(cls, some: list[Codes]) -> Codes:
        before = np.cumsum([0, *(len(c.flat) for c in some)])
        return cls(np.concatenate([c.flat for c in some]), np.concatenate([c.starts + n for c, n in zip(some, before, strict=False)]),
                   np.concatenate([c.sizes for c in some]))

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, which: np.ndarray) -> Codes:
        return Codes(self.flat, self.starts[which], self.sizes[which])

    def packed(self) -> Codes:
        """The same parts in an array of their own."""
        return Codes(values(self, np.arange(len(self)), np.uint8), np.cumsum(self.sizes) - self.sizes, self.sizes)


class Table:
    """Units and their codes; not changed once made."""

    def __init__(self, words: pa.Array | None = None, codes: Codes | None = None):
        self.words = pa.array([], pa.string()) if words is None else words
        self.codes = Codes.of([]) if codes is None else codes

    def __len__(self) -> int:
        return len(self.words)

    def places(self, units: pa.Array) -> np.ndarray:
        """The rows of units, -1 for those that aren't here."""
        if not len(self):
            return np.full(len(units), -1)
        return pc.fill_null(pc.index_in(units, value_set=self.words.cast(units.type)), -1).to_numpy().astype(np.int64)


_MEMOS: list[Memo] = []


class Memo:
    """Codes by unit in two generations. When the younger is full it becomes
    the older, whose units come back when met again: what is met often stays,
    what is met once goes."""

    def __init__(self, limit: int = MEMO_UNITS):
        self.limit = limit
        self.clear()
        _MEMOS.append(self)

    def __len__(self) -> int:
        return len(self.young)

    def clear(self) -> None:
        self.young = self.older = Table()

    def codes(self, units: pa.Array, encode: Callable[[list[str]], list[bytes] | Codes],
              cut: Callable[[str], list[str]] | None = None) -> Codes:
        """The codes of different units, found or made; with ``cut`` those not
        remembered are cut into pre-tokens and these are found or made."""
        young, older = self.young, self.older
        place = young.places(units)
        missing = np.flatnonzero(place < 0)
        back = older.places(units.take(pa.array(missing)))
        place[missing] = back + len(young)
        new, back = missing[back < 0], missing[back >= 0]
        words = units.take(pa.array(new))
        if cut is None:
            fresh, own = Codes.of(encode(words.to_pylist())), np.ones(len(new), bool)
        else:
            fresh, own = self._cut(words, encode, cut)
        place[new] = len(young) + len(older) + np.arange(len(new))
        codes = Codes.joined([young.codes, older.codes, fresh]).take(place)
        keep = np.concatenate([back, new[own]])
        self._add(units.take(pa.array(keep)), codes.take(keep))
        return codes

    def _cut(self, units: pa.Array, encode, cut) -> tuple[Codes, np.ndarray]:
        """The units' codes, and which units aren't pre-tokens themselves."""
        out, own = [Codes.of([])], [np.zeros(0, bool)]
        for at in range(0, len(units), CUT_UNITS):
            parts = list(map(cut, units[at:at + CUT_UNITS].to_pylist()))
            count = np.fromiter(map(len, parts), np.int64, len(parts))
            flat = pa.array([t for p in parts for t in p], units.type).dictionary_encode()
            of_unit = np.concatenate([[0], np.cumsum(count)])
            flat, ends = gathered(self.codes(flat.dictionary, encode), flat.indices.to_numpy(), np.uint8)
            ends = ends[of_unit]
            out.append(Codes(flat, ends[:-1], np.diff(ends)))
            own.append(count != 1)
        return Codes.joined(out), np.concatenate(own)

    def _add(self, units: pa.Array, codes: Codes) -> None:
        """Remember units, but not the longest ones."""
        if len(self) > self.limit:
            self.older, self.young = self.young, Table()
        short = pc.less_equal(pc.utf8_length(units), MEMO_CHARS)
        units, codes = units.filter(short), codes.take(short.to_numpy(zero_copy_only=False))
        if len(units):
            self.young = Table(pa.concat_arrays([self.young.words, units.cast(pa.string())]),
                               Codes.joined([self.young.codes, codes.packed()]))


def forget() -> None:
    """Empty the memories of this worker, which other operators' tasks use next."""
    for memo in _MEMOS:
        memo.clear()


def units(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Cut texts (null as empty) into strings whose encodings joined are
    theirs: the different strings, which of them each unit is, in order, and
    the number of units before each text and after the last."""
    different, which, ends = _units(column)
    return different.to_pylist(), which, ends


def _units(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    column = pc.fill_null(column, "")
    whole = pc.match_substring_regex(column, _RUN)
    words = pc.split_pattern(column.filter(pc.invert(whole)), " ")
    texts, whole = column.filter(whole), whole.to_numpy(zero_copy_only=False)
    count = np.ones(len(column), np.int64)
    count[~whole] = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    ends = np.cumsum(count)
    words = words.flatten().dictionary_encode()
    # A word is one unit with the blank before it (odd) and another at the start of a text (even).
    blank = np.ones(ends[-1] if len(ends) else 0, bool)
    blank[ends - count] = False
    of_whole = np.repeat(whole, count)
    key = 2 * words.indices.to_numpy().astype(np.int64) + blank[~of_whole]
    met = np.zeros(2 * len(words.dictionary), bool)
    met[key] = True
    used = np.flatnonzero(met)
    lead = pa.array([" ", ""], column.type).take(pa.array(1 - used % 2))
    different = pc.binary_join_element_wise(lead, words.dictionary.take(pa.array(used // 2)), pa.scalar("", column.type))
    which = np.empty(len(blank), np.int64)
    which[~of_whole] = (np.cumsum(met) - 1)[key]
    which[of_whole] = len(different) + np.arange(len(texts))
    return pa.concat_arrays([different, texts]), which, np.concatenate([[0], ends])


def by_units(column: pa.Array, encode: Callable[[list[str]], list[bytes] | Codes], memo: Memo,
             cut: Callable[[str], list[str]] | None = None) -> tuple[Codes, np.ndarray, np.ndarray]:
    """Like :func:`units`, with the units' codes instead of them. ``encode``
    maps a list of units that aren't remembered to their codes, or, with
    ``cut``, a list of the pre-tokens that it cuts units into."""
    different, which, ends = _units(column)
    return memo.codes(different, encode, cut), which, ends


def values(parts: Codes, which: np.ndarray, dtype="<u4", block: int = 1 << 18) -> np.ndarray:
    """The values of the parts named, one after the other."""
    flat = parts.flat.view(dtype)
    out = [flat[:0]]
    for at in range(0, len(which), block):
        some = which[at:at + block]
        n = parts.sizes[some] // flat.itemsize
        ends = np.cumsum(n)
        out.append(flat[np.repeat(parts.starts[some] // flat.itemsize - ends + n, n) + np.arange(ends[-1])])
    return np.concatenate(out)


def gathered(parts: Codes, which: np.ndarray, dtype="<u4", block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """The values of the parts named, one after the other, and the number of
    values before each and after the last."""
    ends = np.cumsum(parts.sizes[which]) // np.dtype(dtype).itemsize
    return values(parts, which, dtype, block), np.concatenate([[0], ends])
