"""The words of a byte-level tokenizer, cut by a small deterministic automaton.

The automaton reads one symbol per character.  A symbol is the class of the
character (letter, number, other, blank) together with the little that must be
known of what follows: whether a blank ends its run, and whether an apostrophe
opens one of the English endings.  Its state after every character comes from
a scan over blocks: each block gives a map from entry state to exit state, the
maps are composed pairwise, and then all blocks advance side by side.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
"""Classes of characters; SPACE is U+0020."""

# The characters with the White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols: classes, then blanks by what follows, apostrophes before an ending of one or two letters, and the end of a text.
S_LETTER, S_NUMBER, S_OTHER, S_INNER, S_LAST_SPACE, S_LAST_BLANK, S_ENDING_1, S_ENDING_2, S_END = range(9)
# States: inside a run of letters, numbers, others; after a space that joins what follows; inside blanks; letters of an ending left; fresh.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINING, IN_BLANKS, ONE_LEFT, TWO_LEFT, FRESH = range(8)
STATES, BLOCK = 8, 128


@cache
def character_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        group = unicodedata.category(chr(point))[0]
        if group == "L":
            table[point] = LETTER
        elif group == "N":
            table[point] = NUMBER
    table[WHITE_SPACE] = BLANK
    table[0x20] = SPACE
    return table


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state and whether a word starts, by symbol and state."""
    after = np.full((9, STATES), FRESH, np.uint8)
    starts = np.ones((9, STATES), bool)
    for symbol, run in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS), (S_ENDING_1, IN_OTHERS), (S_ENDING_2, IN_OTHERS)):
        after[symbol] = run
        starts[symbol, [run, JOINING]] = False
    for symbol, left in ((S_ENDING_1, ONE_LEFT), (S_ENDING_2, TWO_LEFT)):
        for state in range(STATES):
            if state not in (IN_OTHERS, JOINING):
                after[symbol, state] = left
    after[S_LETTER, TWO_LEFT], after[S_LETTER, ONE_LEFT] = ONE_LEFT, FRESH
    starts[S_LETTER, [TWO_LEFT, ONE_LEFT]] = False
    after[S_INNER] = IN_BLANKS
    starts[S_INNER, IN_BLANKS] = False
    after[S_LAST_SPACE] = JOINING
    starts[S_END] = False
    return after, starts


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol of every code point; ``ends`` marks the closing character of each text."""
    kinds = character_classes()[points]
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_INNER, S_INNER], np.uint8)[kinds]
    out[ends] = S_END
    blank = (kinds >= BLANK) & ~ends
    visible_next = np.zeros(len(points), bool)
    visible_next[:-1] = ~(blank | ends)[1:]
    last = blank & visible_next
    out[last] = np.where(kinds[last] == SPACE, S_LAST_SPACE, S_LAST_BLANK)
    at = np.flatnonzero((points == ord("'")) & ~ends)
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[at[short]] = S_ENDING_1
        out[at[long]] = S_ENDING_2
    return out


def scan(read: np.ndarray) -> np.ndarray:
    """The state before every symbol, by composing the state maps of blocks."""
    after, _ = automaton()
    count = -(-len(read) // BLOCK)
    padded = np.full(count * BLOCK, S_END, np.uint8)
    padded[: len(read)] = read
    steps = np.ascontiguousarray(padded.reshape(count, BLOCK).T)
    table = after.ravel()
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (count, 1))
    for column in steps:
        maps = table[column[:, None] * np.uint8(STATES) + maps]
    reach = 1
    while reach < count:  # maps[i] becomes the map of blocks i - reach + 1 .. i, twice as many in each round
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.int64), axis=1)
        reach *= 2
    state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8) if count else np.empty(0, np.uint8)
    before = np.empty((BLOCK, count), np.uint8)
    for i, column in enumerate(steps):
        before[i] = state
        state = table[column * np.uint8(STATES) + state]
    return before.T.ravel()[: len(read)]


def decode_points(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 and the byte at which each begins."""
    at = np.flatnonzero((flat & 0xC0) != 0x80)
    lead = flat[at].astype(np.uint32)
    points = lead.copy()
    padded = np.concatenate([flat, np.zeros(3, np.uint8)]).astype(np.uint32)
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
        chosen = np.flatnonzero((lead >= low) & (lead < high))
        if len(chosen):
            value = lead[chosen] & mask
            for k in range(1, more + 1):
                value = (value << np.uint32(6)) | (padded[at[chosen] + k] & 0x3F)
            points[chosen] = value
    return points, at


def word_spans(flat: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word; ``closing`` lists the byte that ends each text and belongs to no word."""
    points, at = decode_points(flat)
    ends = np.zeros(len(flat), bool)
    ends[closing] = True
    ends = ends[at]
    read = symbols(points, ends)
    _, starts = automaton()
    opens = starts.ravel()[read * np.uint8(STATES) + scan(read)]
    edges = np.flatnonzero(opens | ends)
    begin = opens[edges]
    first = at[edges]
    end = np.append(first[1:], len(flat))
    return first[begin], end[begin]
