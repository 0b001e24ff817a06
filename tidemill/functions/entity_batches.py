"""The entities of :mod:`extraction` in Arrow batches, for texts whose characters beyond ASCII belong to no class.

The texts of a slice stand side by side, with a byte between them that no text
holds.  Whole-slice array operations find the few places where a match can lie
(runs of the characters it may hold, month letters, separators of a line); the
patterns of ``fixed_values`` then run at those places only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import fixed_values as fixed

BETWEEN = 0xFF  # in no UTF-8 text
STRINGS = pa.list_(pa.string())
MONEY = pa.struct([("raw", pa.string()), ("amount", pa.float64()), ("currency", pa.string())])
RECORD = "struct<emails:array<string>,phones:array<string>,urls:array<string>,dates:array<string>,monetary:array<struct<raw:string,amount:double,currency:string>>,key_value_pairs:map<string,string>>"


def _compiled(pattern: str) -> re.Pattern[bytes]:
    return re.compile(fixed.without_unicode_classes(pattern).encode())


def _class(*members: str) -> np.ndarray:
    """Which bytes are among the members (a regular expression for one character)."""
    one = re.compile(f"[{''.join(members)}]")
    return np.array([b < 128 and bool(one.match(chr(b))) for b in range(256)])


LOCAL = "a-zA-Z0-9._%+-"
EMAIL = re.compile(rf"[{LOCAL}]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}".encode())
EMAIL_AFTER_RUN_START = re.compile(rf"(?<![{LOCAL}])".encode() + EMAIL.pattern)
EMAIL_RUN = _class("@", LOCAL)
PHONES = [_compiled(fixed.PHONE_US), _compiled(fixed.PHONE_INTERNATIONAL)]
PHONE_RUN, PHONE_DIGITS = _class(r"+.()\t\n\x0b\f\r 0-9-"), 10
URL = _compiled(fixed.URL)
DATE_RUN = _class("/0-9-")
# Pattern and the sign that it holds twice.
NUMBER_DATES, FEWEST_DIGITS = [(_compiled(fixed.DATE_ISO), b"-"), (_compiled(fixed.DATE_SLASHED), b"/")], 4
MONTH_FIRST, DAY_FIRST = _compiled(fixed.DATE_MONTH_FIRST), _compiled(fixed.DATE_DAY_FIRST)
MONTH_LETTERS = [_class("JFMASONDjfmasond"), _class("aepucoAEPUCO"), _class("nbrylgptvcNBRYLGPTVC")]
WORD, DIGIT = _class("a-zA-Z0-9_"), _class("0-9")
SPACES, DIGITS = b"\t\n\x0b\f\r ", b"0123456789"
# A pattern per sign: one that begins with a fixed byte is searched fastest.
PREFIXED = [(sign.encode(), re.compile(re.escape(sign).encode() + fixed.MONEY_AFTER_PREFIX.encode())) for sign in fixed.MONEY_PREFIXES]
CODE_BYTES = len(fixed.MONEY_CODES[0])
# Read backwards, from the rare code to the frequent digits.
SUFFIXED = re.compile(rf"(?:{'|'.join(c[::-1] for c in fixed.MONEY_CODES)})\s*((?:\d{{2}}\.)?[\d,]+)".encode())
FILLED = ~_class(r"\t\n\x0b\f\r\x1c-\x1f ") & (np.arange(256) != BETWEEN)

Spans = tuple[np.ndarray, np.ndarray]


def _spans(found: list[tuple[int, int]]) -> Spans:
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _runs(data: np.ndarray, members: np.ndarray) -> Spans:
    """Starts and ends of the longest runs of the members."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = members[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The texts between the places, as one array."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def _ranks(values: pa.StringArray) -> tuple[np.ndarray, pa.Array]:
    """The place of every value among the distinct ones in order, and these."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def _offsets(rows: np.ndarray, count: int) -> pa.Array:
    """Offsets of lists whose members, in order, belong to these rows."""
    return pa.array(np.searchsorted(rows, np.arange(count + 1)).astype(np.int32))


class _Slice:
    """The texts of a slice side by side."""

    def __init__(self, texts: list[bytes]):
        self.count = len(texts)
        self.bytes = bytes([BETWEEN]).join([*texts, b""])
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.ends = np.cumsum([len(t) + 1 for t in texts])
        self.digits = np.zeros(len(self.data) + 1, np.int32)
        np.cumsum(DIGIT[self.data], out=self.digits[1:])

    def rows(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, starts, side="right")

    def distinct(self, found: list[tuple[int, int]]) -> pa.ListArray:
        """Distinct values per text, in order."""
        starts, ends = _spans(found)
        ranks, values = _ranks(_strings(self.data, starts, ends))
        row, rank = np.divmod(np.unique(self.rows(starts) * (len(values) + 1) + ranks), len(values) + 1)
        return pa.ListArray.from_arrays(_offsets(row, self.count), values.take(pa.array(rank)))

    def emails(self) -> list[tuple[int, int]]:
        starts, ends = _runs(self.data, EMAIL_RUN)
        found = []
        for run in np.unique(np.searchsorted(starts, np.flatnonzero(self.data == ord("@")), side="right") - 1).tolist():
            at, end = int(starts[run]), int(ends[run])
            while match := EMAIL.match(self.bytes, at, end) or EMAIL_AFTER_RUN_START.search(self.bytes, at, end):
                found.append(match.span())
                at = match.end()
        return found

    def _with_digits(self, members: np.ndarray, fewest: int) -> Spans:
        """Runs of the members with so many digits at least."""
        starts, ends = _runs(self.data, members)
        some = self.digits[ends] - self.digits[starts] >= fewest
        return starts[some], ends[some]

    def phones(self) -> list[tuple[int, int]]:
        runs = zip(*(x.tolist() for x in self._with_digits(PHONE_RUN, PHONE_DIGITS)), strict=True)
        return [m.span() for run in runs for p in PHONES for m in p.finditer(self.bytes, *run)]

    def urls(self) -> list[tuple[int, int]]:
        return [m.span() for m in URL.finditer(self.bytes)]

    def dates(self) -> list[tuple[int, int]]:
        text, data, found = self.bytes, self.data, []
        starts, ends = self._with_digits(DATE_RUN, FEWEST_DIGITS)
        for pattern, sign in NUMBER_DATES:
            signs = np.flatnonzero(data == ord(sign))
            some = np.searchsorted(signs, ends) - np.searchsorted(signs, starts) >= 2
            for start, end in zip(starts[some].tolist(), ends[some].tolist(), strict=True):
                found += [m.span() for m in pattern.finditer(text, start, end)]
        if len(data) < 3:
            return found
        month = MONTH_LETTERS[0][data[:-2]]
        month &= MONTH_LETTERS[1][data[1:-1]]
        month &= MONTH_LETTERS[2][data[2:]]
        month[1:] &= ~WORD[data[:-3]]
        done = 0
        for at in np.flatnonzero(month).tolist():
            if match := MONTH_FIRST.match(text, at):
                found.append(match.span())
            gap = at
            while gap > done and text[gap - 1] in SPACES:
                gap -= 1
            day = gap
            while gap < at and day > max(done, gap - 2) and text[day - 1] in DIGITS:
                day -= 1
            if day < gap and (match := DAY_FIRST.match(text, day)):
                found.append(match.span())
                done = match.end()
        return found

    def money(self) -> pa.ListArray:
        text, size = self.bytes, len(self.bytes)
        forwards = [
            (m.start(), m.end(), m.start() + len(sign), m.end(), kind) for kind, (sign, p) in enumerate(PREFIXED) for m in p.finditer(text)
        ]
        backwards = [(size - m.end(), size - m.start(), size - m.end(), size - m.start(1), len(PREFIXED)) for m in SUFFIXED.finditer(text[::-1])]
        starts, ends, number_starts, number_ends, kinds = np.array(forwards + backwards, np.int64).reshape(-1, 5).T
        currencies = pa.concat_arrays([
            pa.array(list(fixed.MONEY_PREFIXES.values()), pa.string()).take(pa.array(kinds[: len(forwards)])),
            _strings(self.data, ends[len(forwards) :] - CODE_BYTES, ends[len(forwards) :]),
        ])
        numbers = _strings(self.data, number_starts, number_ends)
        numbers = pc.replace_substring(numbers, ",", "")
        amounts = pa.array([float(n) if n else None for n in numbers.to_pylist()], pa.float64())
        rows = self.rows(starts)
        order = np.lexsort((starts, kinds, rows))
        order = order[amounts.is_valid().to_numpy(zero_copy_only=False)[order]]
        at = pa.array(order)
        columns = [_strings(self.data, starts[order], ends[order]), amounts.take(at), currencies.take(at)]
        return pa.ListArray.from_arrays(_offsets(rows[order], self.count), pa.StructArray.from_arrays(columns, fields=list(MONEY)))

    def pairs(self) -> pa.MapArray:
        data, filled = self.data, np.flatnonzero(FILLED[self.data])
        separators = [np.flatnonzero(data == ord(s)) for s in fixed.PAIR_SEPARATORS]
        breaks = np.flatnonzero((data == ord("\n")) | (data == BETWEEN))
        line = np.unique(np.searchsorted(breaks, np.concatenate(separators)))
        begin = np.where(line > 0, breaks[line - 1] + 1, 0)
        start = filled[np.searchsorted(filled, begin)]
        end = filled[np.searchsorted(filled, breaks[line]) - 1] + 1
        cut = np.full(len(line), -1)
        for places in reversed(separators):
            at = np.append(places, len(data))[np.searchsorted(places, start + 1)]
            cut = np.where(at < end - 1, at, cut)
        start, end, cut = (x[cut >= 0] for x in (start, end, cut))
        key_end = filled[np.searchsorted(filled, cut) - 1] + 1
        value_start = filled[np.searchsorted(filled, cut + 1)]
        keys, values = _strings(data, start, key_end), _strings(data, value_start, end)
        short = pc.less(pc.utf8_length(keys), fixed.PAIR_KEY_LIMIT)
        rows = self.rows(start)[short.to_numpy(zero_copy_only=False)]
        keys, values = keys.filter(short), values.filter(short)
        ranks, _ = _ranks(keys)
        # The last pair of a key stands first among the reversed ones.
        _, back = np.unique((rows * (len(keys) + 1) + ranks)[::-1], return_index=True)
        last = len(keys) - 1 - back
        kept = pa.array(last, pa.int64())
        return pa.MapArray.from_arrays(_offsets(rows[last], self.count), keys.take(kept), values.take(kept))


def records(texts: pa.StringArray) -> pa.StructArray:
    """One record per text, as :func:`extraction.extract_all` gives it; a NULL text has an empty one."""
    held = _Slice(texts.cast(pa.binary()).fill_null(b"").to_pylist())
    columns = {
        "emails": held.distinct(held.emails()),
        "phones": held.distinct(held.phones()),
        "urls": held.distinct(held.urls()),
        "dates": held.distinct(held.dates()),
        "monetary": held.money(),
        "key_value_pairs": held.pairs(),
    }
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
