"""Text features computed from UTF-8 bytes with numpy, shared by the classifiers."""

from __future__ import annotations

import numpy as np

from wxmesh.llm.common import buckets, byte_codes

#: The white space of the word pattern ``[^\\x20\\x09-\\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Bytes inside an alphanumeric word: ASCII letters, digits, and all of multi-byte characters.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def prefix_codes(raw: bytes, starts: np.ndarray, lengths: np.ndarray, size: int = 8) -> np.ndarray:
    """The first ``size`` (at most 8) bytes of each word as one number; shorter words are zero-filled."""
    a = np.frombuffer(raw + b"\0" * 8, np.uint8)
    codes = np.zeros(len(starts), np.uint64)
    for j in range(size):
        codes |= np.where(lengths > j, a[starts + j], 0).astype(np.uint64) << np.uint64(8 * j)
    return codes


#: An odd base, and what undoes a multiplication by it, for sums of bytes times powers modulo 2**64.
BASE = 0x9E3779B97F4A7C15
UNDO = pow(BASE, -1, 1 << 64)
POWERS_KEPT = 1 << 20


def _powers(of: int, n: int) -> np.ndarray:
    factors = np.full(n, of, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


KEPT = _powers(BASE, POWERS_KEPT), _powers(UNDO, POWERS_KEPT)


def word_codes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word, from all of its bytes and its length."""
    a = np.frombuffer(raw, np.uint8)
    up, down = KEPT if len(a) < POWERS_KEPT else (_powers(BASE, len(a) + 1), _powers(UNDO, len(a) + 1))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], dtype=np.uint64)))
    codes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    codes ^= codes >> np.uint64(29)
    codes *= np.uint64(0xBF58476D1CE4E5B9)
    return codes ^ codes >> np.uint64(32)


def root_shares(ids: np.ndarray, size: int) -> np.ndarray:
    """Square roots of the bucket shares: a vector of unit length (zero without ids)."""
    counts = np.bincount(ids, minlength=size).astype(np.float32)
    return np.sqrt(counts / max(1, len(ids)))


def hashed_grams(raw: bytes, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed byte n-grams, as one vector of ``2**bits`` root shares."""
    ids = [buckets(byte_codes(raw, n), bits, n) for n in orders]
    return root_shares(np.concatenate(ids), 1 << bits)


def hashed_words(raw: bytes, bits: int) -> np.ndarray:
    """Hashed white-space words and word pairs, as one vector of ``2**bits`` root shares."""
    a = np.frombuffer(raw, np.uint8)
    codes = word_codes(raw, *spans(~SPACE[a]))
    pairs = codes[:-1] * np.uint64(3) + codes[1:]
    return root_shares(np.concatenate((buckets(codes, bits, 11), buckets(pairs, bits, 12))), 1 << bits)


STYLE = ("log_words", "word_length", "symbols", "bars", "bangs", "upper", "digits", "high", "punctuation",
         "distinct", "top_word", "distinct_pairs", "line_words", "same_lines", "marked_words", "shouted_words")


def style(raw: bytes) -> np.ndarray:
    """Shares and ratios that describe how a text is written, in the order of ``STYLE``."""
    a = np.frombuffer(raw, np.uint8)
    starts, ends = spans(~SPACE[a])
    n = max(1, len(starts))
    count = np.bincount(a, minlength=256)
    chars = max(1, len(a) - int(count[SPACE].sum()))
    codes = word_codes(raw, starts, ends)
    _, per_word = np.unique(codes, return_counts=True)
    pairs = np.unique(codes[:-1] * np.uint64(3) + codes[1:])
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda text: count[list(text)].sum() / chars
    last = a[ends - 1] if len(ends) else a[:0]
    upper = np.concatenate(([0], np.cumsum((a >= 65) & (a <= 90))))
    lower = np.concatenate(([0], np.cumsum((a >= 97) & (a <= 122))))
    ups, lows = upper[ends] - upper[starts], lower[ends] - lower[starts]
    letters = max(1, int(upper[-1] + lower[-1]))
    return np.array([
        np.log1p(len(starts)), chars / n, share(b"#*$%&<>"), share(b"|"), share(b"!"), upper[-1] / letters,
        share(b"0123456789"), count[128:].sum() / chars, share(b".,;:?"),
        len(per_word) / n, per_word.max(initial=0) / n, len(pairs) / n,
        len(starts) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        np.isin(last, np.frombuffer(b"#*$%&|<>", np.uint8)).sum() / n, ((ups > 1) & (lows == 0)).sum() / n,
    ], np.float32)
