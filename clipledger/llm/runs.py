"""Periodic runs of words in texts: stretches that repeat a period, found by frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q, of at least max(12, 2 q) words, that no neighbouring
word extends keeping q. All of it holds at least two of each of its words, so a word that occurs once in a segment
belongs to no run inside it and splits the segment; the pieces are counted anew until nothing changes. What is left is scanned lag by
lag. A run of period q has h = max(q, 12 - q) or more neighbouring places that equal the place q on, so one of them
is a multiple of h: only these are looked at, and one of its two sides agrees for h / 2 words or more. Names of
substrings of 1, 2, 4, ... words tell so, and how far a match reaches, exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clipledger.llm.support import pieces

LEAST_WORDS = 12
#: Rounds of splitting; whatever could be split further is scanned all the same.
ROUNDS = 100
#: Places of one scan that are compared at a time.
AT_ONCE = 1 << 20

Rewrite = Callable[[int | None, np.ndarray], np.ndarray]


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches that may hold runs: each word occurs twice or more in its stretch."""
    at = np.arange(len(ids))
    done: list[tuple[int, int]] = []
    for turn in range(ROUNDS):
        if not len(at):
            break
        # Neighbouring places make a segment; too short ones go.
        new = np.concatenate([[True], np.diff(at) > 1]) if turn == 0 else np.concatenate([[True], (np.diff(at) > 1) | (np.diff(group) > 0)])
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        keep = (size >= LEAST_WORDS)[number]
        at, number = at[keep], number[keep]
        if not len(at):
            break
        pair = number.astype(np.int64) * (int(ids.max()) + 1) + ids[at]
        _, where, count = np.unique(pair, return_inverse=True, return_counts=True)
        rare = count[where] < 2
        changed = np.bincount(number, weights=rare, minlength=len(size)) > 0
        settled = ~changed[number]
        done += _stretches(at[settled], number[settled])
        left = changed[number] & ~rare
        at, group = at[left], number[left]
    else:
        done += [(a, b) for a, b in _stretches(at, group) if b - a >= LEAST_WORDS]
    return sorted(done)


def _stretches(at: np.ndarray, number: np.ndarray) -> list[tuple[int, int]]:
    if not len(at):
        return []
    turns = np.flatnonzero((np.diff(at) > 1) | (np.diff(number) > 0))
    firsts, lasts = np.concatenate([[0], turns + 1]), np.concatenate([turns, [len(at) - 1]])
    return list(zip(at[firsts].tolist(), (at[lasts] + 1).tolist()))


class Names:
    """Names of all substrings of 2 ** k words: equal names stand for equal words. Levels end where no name occurs twice."""

    def __init__(self, ids: np.ndarray):
        self.size = len(ids)
        self.levels = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
        while True:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            if len(last) <= step or int(last.max()) + 1 == len(last):
                break
            pair = last[:-step] * (int(last.max()) + 1) + last[step:]
            self.levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on; a < b."""
        a, b = a.copy(), b.copy()
        since = a.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            while True:  # the top level may be taken several times
                room = b < len(names)
                same = np.zeros(len(a), bool)
                same[room] = names[a[room]] == names[b[room]]
                if not same.any():
                    break
                a[same] += 1 << k
                b[same] += 1 << k
                if k < len(self.levels) - 1:
                    break
        return a - since

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b; a < b."""
        a, b = a.copy(), b.copy()
        since = a.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[k], 1 << k
            while True:
                room = a >= step
                same = np.zeros(len(a), bool)
                same[room] = names[a[room] - step] == names[b[room] - step]
                if not same.any():
                    break
                a[same] -= step
                b[same] -= step
                if k < len(self.levels) - 1:
                    break
        return since - a


def lag_scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment."""
    n = len(ids)
    names = Names(ids)
    found: dict[tuple[int, int], int] = {}
    long: list[tuple[int, int, int]] = []
    lag = 1
    while 2 * lag <= n:
        gap = max(lag, LEAST_WORDS - lag)
        level = (-(-gap // 2)).bit_length() - 1
        if level >= len(names.levels):
            break  # no substring of so many words occurs twice, and none of more
        # Lags of one level, as many as make AT_ONCE places.
        lags, places = [], 0
        while 2 * lag <= n and places < AT_ONCE:
            gap = max(lag, LEAST_WORDS - lag)
            if (-(-gap // 2)).bit_length() - 1 != level:
                break
            lags.append(lag)
            places += (n - lag - 1) // gap + 1
            lag += 1
        some = np.array(lags, np.int64)
        gaps = np.maximum(some, LEAST_WORDS - some)
        counts = (n - some - 1) // gaps + 1
        q = np.repeat(some, counts)
        a = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * np.repeat(gaps, counts)
        near = names.levels[level]
        step = 1 << level
        match = np.zeros(len(a), bool)
        room = a + q < len(near)
        match[room] = near[a[room]] == near[a[room] + q[room]]
        room = ~match & (a >= step)
        match[room] = near[a[room] - step] == near[a[room] + q[room] - step]
        for start, end, period in long:  # multiples of a known period inside its run
            match &= ~((q % period == 0) & (q > period) & (a >= start) & (a + q < end))
        a, q = a[match], q[match]
        fore, back = names.ahead(a, a + q), names.behind(a, a + q)
        length = fore + back + q
        good = length >= np.maximum(LEAST_WORDS, 2 * q)
        for start, size, period in zip((a - back)[good].tolist(), length[good].tolist(), q[good].tolist()):
            # Lags ascend: the first one to give a stretch is its smallest period.
            if found.setdefault((start, start + size), period) == period and size >= 64 * period and (start, start + size, period) not in long:
                long.append((start, start + size, period))
    return sorted((start, end - start, period) for (start, end), period in found.items())


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    found = []
    for start, end in segments(ids):
        found += [(start + s, length, period) for s, length, period in lag_scan(ids[start:end])]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Places of words that no run contains after its first period."""
    turns = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    return np.flatnonzero(np.cumsum(turns)[:-1] == 0)


FOUND = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, collapsed string, runs array<struct<start:long,length:long,period:long>>"
)


def _words(text: bytes | None) -> tuple[list[bytes], np.ndarray]:
    """Words as UTF-8 (split at the six ASCII blanks), and a number for each: equal ones for equal words."""
    words = (text or b"").split()
    known: dict[bytes, int] = {}
    return words, np.array([known.setdefault(word, len(known)) for word in words], np.int64)


def _described(key: int | None, text: bytes | None, rewrite: Rewrite | None, full: bool) -> dict:
    words, ids = _words(text)
    if rewrite is not None and len(words):
        places = rewrite(key, np.arange(len(words)))
        words, ids = [words[k] for k in places.tolist()], ids[places]
    runs = find_runs(ids)
    collapsed = b" ".join([words[k] for k in kept_words(len(words), runs).tolist()]) if runs else b" ".join(words)
    start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return {
        "n_words": len(words),
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": 1000 * length // period if runs else None,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(collapsed).hexdigest(),
        "collapsed": collapsed.decode() if full else None,
        "runs": [{"start": s, "length": size, "period": q} for s, size, q in runs] if full else None,
    }


def repeated_runs(docs: DataFrame, rewrite: Rewrite | None = None, full: bool = True) -> DataFrame:
    """Runs of every text: one row per document, with doc_id and the columns of ``FOUND``.

    start, length, period and exponent_milli (thousandths, rounded down) are those of the longest run, of equal ones
    that with the smallest start, then period; null where there is none. runs_sha256 is of a line ``start,length,period`` for
    each run, collapsed_sha256 of the words outside repetitions joined by blanks; with ``full`` both come in full too.

    Words are what ASCII blanks separate; start counts words from 0. Null and empty texts have no words; null doc_ids and
    repeated rows each get their row; no rows give none. Other columns are ignored. ``rewrite`` maps places of a
    document's words to places whose words stand there instead.
    """
    schema = f"doc_id long, {FOUND}"
    kinds = {
        "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
        **dict.fromkeys(("runs_sha256", "collapsed_sha256", "collapsed"), pa.string()),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                keys = part.column("doc_id").to_pylist()
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                rows = [_described(key, text, rewrite, full) for key, text in zip(keys, texts)]
                names = list(rows[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array([row[name] for row in rows], kinds.get(name, pa.int64())) for name in names),
                    ],
                    names=["doc_id", *names],
                )

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(run, schema)


def planted(key: int | None, places: np.ndarray) -> np.ndarray:
    """A tail that repeats, in one document of ten: h is the CRC-32 of the doc_id in decimals; without one nothing changes."""
    n = len(places)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return places
    g = h // 10
    since = g % n
    period = 1 + (n - since) // (3 + g % 8)
    return np.where(places >= since, since + (places - since) % period, places)
