import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from clipledger.llm import runs as R
from clipledger.llm.queries import QUERIES
from tests.llm.cases import SCHEMA, SMALL, awkward, frame, prose, real_rows


def plain_runs(words):
    """All runs, by trying every period and keeping the smallest one of each stretch."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def replanted(key, words):
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def model(rows, rewrite=lambda key, words: words):
    out = []
    for key, text in rows:
        words = rewrite(key, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = plain_runs(words)
        dropped = {k for s, size, q in runs for k in range(s + q, s + size)}
        best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
        longest = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        out.append((key, len(runs), *longest, digest(listed), digest(kept)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def plain(found):
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_like_every_period_tried(seed):
    rng = random.Random(seed)
    for _ in range(250):
        letters = rng.randrange(1, 6)
        ids = []
        while len(ids) < rng.randrange(1, 160):
            if rng.random() < 0.5:
                ids += [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
            else:
                ids += [rng.randrange(letters + 3) for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 7)
        assert R.find_runs(np.array(ids, np.int64)) == plain_runs(ids)


def test_words_that_never_repeat():
    """Fibonacci and Thue-Morse words: many runs of many periods, and none longer than twice a period."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert R.find_runs(np.array(b, np.int64)) == plain_runs(b)
    t = [bin(i).count("1") % 2 for i in range(1024)]
    assert R.find_runs(np.array(t, np.int64)) == plain_runs(t)


def test_segments_hold_all_runs():
    rng = random.Random(11)
    for _ in range(200):
        ids = [rng.randrange(300) for _ in range(40)] + [rng.randrange(4) for _ in range(rng.randrange(20))] * 3
        ids += [rng.randrange(300) for _ in range(rng.randrange(40))]
        kept = R.segments(np.array(ids, np.int64))
        for start, length, _ in plain_runs(ids):
            assert any(a <= start and start + length <= b for a, b in kept)
        for a, b in kept:
            assert b - a >= 12 and all(ids[a:b].count(x) > 1 for x in ids[a:b])
    assert R.segments(np.arange(1000)) == R.segments(np.empty(0, np.int64)) == []


def test_long_texts_are_no_trouble():
    for ids in (np.zeros(300_000, np.int64), np.arange(300_000) % 7, np.arange(300_000) % 40_000):
        (start, length, period), = R.find_runs(ids)
        assert (start, length) == (0, 300_000) and period == len(np.unique(ids))
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 50, 300_000)
    ids[1000:21_000] = np.tile(ids[1000:2000], 20)
    assert (1000, 20_000, 1000) in [(s, size - size % 1000, q) for s, size, q in R.find_runs(ids)]


def test_documents(spark):
    rows = [r[:2] for r in awkward() if len(r[1] or "") < 100_000]
    rows += [(100 + k, prose(k, 40) + " " + f"{prose(50 + k, 3 + k)} " * (2 + k % 5) + prose(80 + k, 9)) for k in range(12)]
    rows += [(None, "a b " * 30), (300, "x " * 12), (301, "x " * 11), (302, "p\tq\nr\x0bs\x0ct\ru " * 2), (303, "a\x1cb " * 12)]
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    found = R.repeated_runs(docs)
    assert plain(found) == model(rows)
    for r in found.collect():
        assert len(r.runs) == r.n_runs
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256


def test_empty(spark):
    assert R.repeated_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    rows = [r[:2] for r in real_rows() if len(r[1] or "") < 20_000]
    known = {r[0] for r in rows}
    found = [r for r in plain(QUERIES["op12_runs"](spark, SMALL)) if r[0] in known]
    assert found == model(rows, replanted)
    assert sum(r[1] > 0 for r in found) > len(found) / 20
