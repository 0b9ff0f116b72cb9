"""Statistics of whole documents, counted on UTF-8 bytes with C-level primitives."""

from __future__ import annotations

from collections import Counter

import numpy as np

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_LETTER = bytes(range(97, 123)) + _UPPER
_CONT = bytes(range(0x80, 0xC0))
_END = (b".", b"!", b"?", b":", b'"', b"\xe3\x80\x82", b"\xe2\x80\xa6")

#: Texts of more words than this are handled in arrays.
LONG_WORDS = 200_000
#: What ``counts`` returns, in this order.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_upper", "n_digits",
    "n_letters", "n_pipes", "n_marks", "n_lines", "n_open_lines", "n_short_lines", "n_distinct", "n_same_next", "n_commas",
)
#: What ``ratios`` makes of them.
RATIOS = (
    "log_words", "word_len", "symbols", "dup_lines", "repeat_words", "upper", "digits", "letters", "pipes", "marks",
    "open_lines", "short_lines", "distinct", "same_next", "commas",
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more."""
    if len(words) > LONG_WORDS:
        return _repeated_in_long(words)
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _repeated_in_long(words: list[bytes]) -> int:
    """The same over arrays of word numbers, which take a fraction of the memory."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    pair = np.unique(ids[:-2] * len(known) + ids[1:-1], return_inverse=True)[1].reshape(-1)
    _, which, times = np.unique(pair * len(known) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which.reshape(-1)] > 1)
    hit = np.zeros(len(words), dtype=bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def counts(text: bytes | None) -> tuple[int, ...]:
    """The statistics of one text; a null text has no words."""
    b = text or b""
    words = b.split()
    n = len(words)
    joined = b"".join(words)
    lines = [x for x in b.split(b"\n") if x.strip()]
    return (
        n, len(joined.translate(None, _CONT)), sum(map(b.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(b), len(b) - len(b.translate(None, _UPPER)), len(b) - len(b.translate(None, _DIGIT)),
        len(b) - len(b.translate(None, _LETTER)), b.count(b"|"), b.count(b"!") + b.count(b"?"), len(lines),
        sum(not x.rstrip().endswith(_END) for x in lines), sum(x.count(b" ") < 3 for x in lines), len(set(words)),
        sum(map(bytes.__eq__, words, words[1:])), b.count(b","),
    )


def ratios(c: np.ndarray) -> np.ndarray:
    """Rows of ``counts`` to rows of RATIOS, finite for empty texts too."""
    c = np.asarray(c, dtype=np.float64).reshape(-1, len(COUNTS))
    k = {name: c[:, i] for i, name in enumerate(COUNTS)}
    words, lines, size = np.maximum(k["n_words"], 1), np.maximum(k["n_lines"], 1), np.maximum(k["n_bytes"], 1)
    return np.stack([
        np.log1p(k["n_words"]), k["word_chars"] / words, k["n_symbols"] / words, k["n_dup_lines"] / lines,
        k["n_repeat_words"] / words, k["n_upper"] / size, k["n_digits"] / size, k["n_letters"] / size,
        k["n_pipes"] / words, k["n_marks"] / words, k["n_open_lines"] / lines, k["n_short_lines"] / lines,
        k["n_distinct"] / words ** 0.9, k["n_same_next"] / words, k["n_commas"] / words,
    ], axis=1)
