"""Noisy-channel restoring of disguised words: Viterbi over character lattices under a character model.

Disguises are letters written as digits or marks (``1d10t``), letters set apart (``i d i o t``) and
letters repeated (``idiiiot``, inside a disguise also ``1diioot``). Each character of such a stretch becomes
the letters it may stand for, or nothing, at a cost; the cheapest path by channel and language model is the
restored text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa

from kerbside.llm.text_arrays import chunks

#: Codes: 0 a gap, 1 to 26 the letters, 27 any other letter.
CODES, ORDER = 32, 4
GRAMS = CODES**ORDER
OTHER = 27

# The usual disguises of letters.
DISGUISES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il",
}
#: Costs in nats: a letter in disguise, a mark or digit that means itself, a repeated letter that is dropped
#: (of three or more; of two, as double letters are usual), and a mark between letters that is dropped.
SWAPPED, KEPT, REPEATED, DOUBLED, APART = 1.0, 2.0, 2.0, 6.0, 0.5
#: Marks that are no punctuation seldom mean themselves beside a letter.
ODD, KEPT_ODD = "$@", 4.0
#: Decoded stretches that a worker remembers, over all its tasks with one model: a few megabytes.
CACHED = 20_000
#: Weight of the shorter context in the model.
BACK = 5.0

_MARKS = re.escape("".join(DISGUISES))
#: A mark beside a letter: the stretch of letters and marks around it is in doubt.
_LEET_CORE = re.compile(rf"[{_MARKS}](?:(?<=[A-Za-z].)|(?=[A-Za-z]))")
_LEET_RUN = re.compile(rf"[A-Za-z{_MARKS}]+")
#: One letter or mark, however often, between separators, however many and of whatever kind. A start behind the same
#: character is not tried, nor are runs given back, so the work is linear in the text.
_APART = re.compile(
    rf"(?<![^\W_])(?:(?<=(.))(?!\1)|(?<!.))(?:([A-Za-z{_MARKS}])\2*+[ .\-_*]++){{2,}}([A-Za-z{_MARKS}])\3*+(?![^\W_])",
    re.IGNORECASE | re.DOTALL,
)
_TRIPLE = re.compile(r"([A-Za-z])\1\1", re.IGNORECASE)
_LETTERS = re.compile(r"[A-Za-z]+")


def _codes() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for at in range(26):
        out[97 + at] = out[65 + at] = at + 1
    out[0xC0:] = OTHER
    out[0x80:0xC0] = -1  # inside a character
    return out


_CODES = _codes()


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): how often each run of four codes occurs in the texts of a task, gaps taken as one."""
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            codes = np.insert(_CODES[data], offsets[:-1], 0)
            codes = np.concatenate(([0, 0], codes[codes >= 0], [0]))
            codes = codes[np.concatenate(([True, True, True], (codes[3:] != 0) | (codes[2:-1] != 0)))]
            if len(codes) >= ORDER:
                # A gap stands for everything before it as well: contexts begin anew at a gap.
                a, b, c, d = (codes[at : len(codes) - ORDER + 1 + at] for at in range(ORDER))
                b = np.where(c == 0, 0, b)
                a = np.where(b == 0, 0, a)
                total += np.bincount(((a * CODES + b) * CODES + c) * CODES + d, minlength=GRAMS)
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["gram", "n"])


def log_model(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log P(code | three codes before), each order smoothed with the shorter one."""
    full = np.zeros(GRAMS)
    full[grams] = counts
    full = full.reshape((CODES,) * ORDER)
    model = np.full(CODES, 1.0 / CODES)
    for order in range(1, ORDER + 1):
        part = full.sum(axis=tuple(range(ORDER - order)))
        model = (part + BACK * model) / (part.sum(axis=-1, keepdims=True) + BACK)
    return np.log(model).astype(np.float32).reshape(-1)


def _code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else OTHER if char.isalpha() else 0


#: What the tasks of a worker have decoded so far, for the model they used last.
_DECODED: dict[bytes, dict[str, str]] = {}


class Restorer:
    def __init__(self, model: np.ndarray):
        self.model = model
        key = hashlib.blake2b(np.ascontiguousarray(model).data).digest()
        if key not in _DECODED:
            _DECODED.clear()
        self.known = _DECODED.setdefault(key, {})

    def _options(self, text: str) -> Iterator[tuple[list[tuple[str, float]], bool, float]]:
        """For each character: what may be meant ("" nothing) and the cost; whether it repeats a mark; the
        cost if it is the letter before once more and dropped."""
        for char, run in groupby(text):
            size = len(list(run))
            again = REPEATED if size > 2 else DOUBLED
            for at in range(size):
                if char.isalpha():
                    yield [(char, 0.0)], False, again
                elif char in DISGUISES:
                    kept = KEPT_ODD if char in ODD else KEPT
                    yield [(char, kept), *((letter, SWAPPED) for letter in DISGUISES[char])], at > 0, SWAPPED + again
                else:
                    yield [(char, 0.0), ("", APART)], False, 0.0

    def decode(self, text: str) -> str:
        """The most likely meaning of a stretch (lower case)."""
        model = self.model
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for options, same, again in self._options(text):
            after: dict[int, tuple[float, tuple | None]] = {}
            for context, (score, path) in states.items():
                last = context % CODES
                for meant, cost in options:
                    if meant:
                        code = _code(meant)
                        # Equal marks side by side are all letters or all marks.
                        if same and (code == 0) != (last == 0):
                            continue
                        if code == 0 and last == 0:
                            total, new = score - cost, context
                        else:
                            total = score - cost + float(model[context * CODES + code])
                            new = (context * CODES + code) % (CODES * CODES * CODES) if code else 0
                        step = (meant, path)
                        # The same letter once more, however it is written.
                        if code and code == last and (context not in after or score - again > after[context][0]):
                            after[context] = (score - again, path)
                    else:
                        total, new, step = score - cost, context, path
                    if new not in after or total > after[new][0]:
                        after[new] = (total, step)
            states = after
        ends = (
            (score + (float(model[context * CODES]) if context % CODES else 0.0), -context, path)
            for context, (score, path) in states.items()
        )
        path = max(ends, key=lambda end: end[:2])[2]
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def _restored(self, match: re.Match) -> str:
        return self._meant(match.group())

    def _meant(self, text: str) -> str:
        text = text.lower()
        tail = ""
        if text and not (text[-1].isascii() and text[-1].isalnum()):
            bare = text.rstrip(text[-1])
            if len(text) - len(bare) >= 3:
                text, tail = bare, text[len(bare) :]
        if not text:
            return tail
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[text] = self.decode(text)
        return found + tail

    def restore(self, text: str) -> str:
        """The text with every suspicious stretch as it is most likely meant; the rest as it is."""
        text = _APART.sub(self._restored, text)
        text = self._widened(text, _LEET_CORE, _LEET_RUN, _RUN)
        return self._widened(text, _TRIPLE, _LETTERS, _ALPHABET)

    def _widened(self, text: str, core: re.Pattern, stretch: re.Pattern, inside: frozenset[str]) -> str:
        """The text with each stretch that holds a match of ``core`` as it is meant; every stretch is walked once."""
        out, done = [], 0
        for found in core.finditer(text):
            first = found.start()
            if first < done:
                continue
            while first > done and text[first - 1] in inside:
                first -= 1
            run = stretch.match(text, first)
            out += (text[done:first], self._meant(run.group()))
            done = run.end()
        return "".join(out) + text[done:] if out else text


_ALPHABET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_RUN = _ALPHABET.union(DISGUISES)


def _flags() -> tuple[np.ndarray, ...]:
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    mark = np.zeros(256, bool)
    mark[[ord(char) for char in DISGUISES]] = True
    apart = np.zeros(256, bool)
    apart[[ord(char) for char in " .-_*"]] = True
    return letter, mark, apart


_LETTER, _MARK, _SEPARATOR = _flags()
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _first_bytes(offsets: np.ndarray, size: int) -> np.ndarray:
    """True at the first byte of a text: what stands before it is no part of it."""
    out = np.zeros(size, bool)
    out[offsets[:-1][offsets[:-1] < size]] = True
    return out


def suspicious(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts may hold a disguise (never too few)."""
    letter, mark, apart = _LETTER[data], _MARK[data], _SEPARATOR[data]
    signs = np.zeros(len(data), bool)
    if len(data) > 1:
        signs[1:] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
    if len(data) > 2:
        low = data | 32
        signs[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & letter[1:-1]
    if len(data) > 4:
        # Of ``_APART`` the end of a first unit, separators, equal characters, and a separator behind them.
        size, low, places = len(data), np.where(letter, data | 32, data), np.arange(len(data))
        one, word = letter | mark, letter | _DIGIT[data]
        first = one & _first_bytes(offsets, size)
        first[1:] |= one[1:] & (~word[:-1] | (low[1:] == low[:-1]))
        before = np.maximum.accumulate(np.where(apart, 0, places))
        second = np.zeros(size, bool)
        second[1:] = one[1:] & apart[:-1] & first[before[:-1]]
        begun = np.maximum.accumulate(np.where(np.concatenate(([True], low[1:] != low[:-1])), places, 0))
        signs[1:] |= apart[1:] & one[:-1] & second[begun[:-1]]
    seen = np.concatenate(([0], np.cumsum(signs)))
    return seen[offsets[1:]] > seen[offsets[:-1]]
