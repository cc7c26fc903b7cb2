"""Alignment of many reads with a window each: bit-parallel columns of edit distances.

Of a column of distances only the differences between neighbours are kept, as two bits a read letter, so that a word has 64 rows
and one pass of a few word operations moves a column on for all pairs at once. Where an alignment starts is found from its end: the
reversed read against the reversed window, fixed at the end, first has the least distance at the shortest part that reaches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Words of letter masks that a batch of pairs holds.
CELLS = 1 << 19
ONE, ALL = np.uint64(1), np.uint64((1 << 64) - 1)


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points one after another, and each text's length."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.array([len(t) for t in texts], np.int64)


def _rows(flat: np.ndarray, sizes: np.ndarray, fill: int, from_end: np.ndarray | None = None) -> np.ndarray:
    """A row for each text, followed by ``fill``; with ``from_end`` that many of its first letters, the last of them first."""
    used = sizes if from_end is None else from_end
    out = np.full((len(sizes), int(used.max(initial=0))), fill, np.int64)
    row = np.repeat(np.arange(len(sizes)), used)
    place = np.arange(len(row)) - np.repeat(np.cumsum(used) - used, used)
    first = np.cumsum(sizes) - sizes
    out[row, place] = flat[first[row] + (place if from_end is None else from_end[row] - 1 - place)]
    return out


def _masks(reads: np.ndarray, lengths: np.ndarray, letters: int, words: int) -> np.ndarray:
    """letters + 1 x pairs x words: where each letter stands in each read; the last letter stands for those of no read."""
    out = np.zeros((letters + 1, len(reads), words), np.uint64)
    for i in range(reads.shape[1]):
        row = np.flatnonzero(lengths > i)
        out[reads[row, i], row, i >> 6] |= ONE << np.uint64(i & 63)
    return out


def _columns(masks: np.ndarray, lengths: np.ndarray, texts: np.ndarray, fixed: bool) -> Iterator[np.ndarray]:
    """After each letter of the texts, the distance of each whole read from a part that ends there.

    ``fixed``: from the part that starts at the first letter; else from any.
    """
    _, n, words = masks.shape
    plus, minus = np.full((words, n), ALL), np.zeros((words, n), np.uint64)
    top = [np.full(n, 63, np.uint64)] * (words - 1) + [((lengths - 1) & 63).astype(np.uint64)]
    score, rows = lengths.copy(), np.arange(n)
    for codes in texts.T:
        equal = masks[codes, rows]
        up, down = np.full(n, ONE if fixed else 0, np.uint64), np.zeros(n, np.uint64)
        for k in range(words):
            p, m, e = plus[k], minus[k], equal[:, k]
            vertical = e | m
            e = e | down
            level = (((e & p) + p) ^ p) | e
            rise, fall = m | ~(level | p), p & level
            over, under = rise >> top[k] & ONE, fall >> top[k] & ONE
            rise, fall = rise << ONE | up, fall << ONE | down
            plus[k], minus[k] = fall | ~(vertical | rise), rise & vertical
            up, down = over, under
        score = score + up.astype(np.int64) - down.astype(np.int64)
        yield score


def semi_global_many(reads: list[str], windows: list[str]) -> list[tuple[int, int]]:
    """Of each pair the least edits of the whole read against any part of the window, and the part's start.

    Of equal edits the first end, and of those parts the last start. A read that no part betters has as many edits as letters and
    starts at 0.
    """
    out: list[tuple[int, int]] = [(0, 0)] * len(reads)
    lengths, sizes = np.array([len(r) for r in reads], np.int64), np.array([len(w) for w in windows], np.int64)
    alphabet = np.unique(_letters(reads)[0])
    words = -(-lengths // 64)
    order = np.lexsort((sizes, words))
    order = order[words[order] > 0]
    a = 0
    while a < len(order):
        w = int(words[order[a]])
        b = min(int(np.searchsorted(words[order], w, "right")), a + max(1, CELLS // (w * (len(alphabet) + 1))))
        pick = order[a:b]
        for i, e, s in zip(pick.tolist(), *_aligned([reads[i] for i in pick], [windows[i] for i in pick], alphabet, w), strict=True):
            out[i] = (e, s)
        a = b
    return out


def _aligned(reads: list[str], windows: list[str], alphabet: np.ndarray, words: int) -> tuple[list[int], list[int]]:
    coded = []
    for texts in (reads, windows):
        flat, sizes = _letters(texts)
        at = np.searchsorted(alphabet, flat)
        coded.append((np.where(alphabet[np.minimum(at, len(alphabet) - 1)] == flat, at, len(alphabet)), sizes))
    (q, m), (t, width) = coded
    none = len(alphabet)
    best, end = m.copy(), np.zeros(len(m), np.int64)
    # what follows a short window is a letter of no read, which never betters an earlier end
    for j, score in enumerate(_columns(_masks(_rows(q, m, none), m, none, words), m, _rows(t, width, none), fixed=False), 1):
        better = score < best
        best[better], end[better] = score[better], j
    begin = np.where(best < m, -1, 0)
    part = np.minimum(end, m + best)  # an alignment of so many edits is no longer
    ends = _rows(t, width, none, end)[:, : int(part.max(initial=0))]
    for j, score in enumerate(_columns(_masks(_rows(q, m, none, m), m, none, words), m, ends, fixed=True), 1):
        found = (begin < 0) & (score == best) & (j <= end)
        begin[found] = end[found] - j
        if (begin >= 0).all():
            break
    return best.tolist(), begin.tolist()


def semi_global(read: str, window: str) -> tuple[int, int]:
    """:func:`semi_global_many` of one pair."""
    return semi_global_many([read], [window])[0]
