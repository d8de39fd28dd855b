import hashlib
import random
import re

from clipledger.llm.decontaminate import contamination_report
from tests.llm.cases import SCHEMA, awkward, frame, prose, real_rows


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def model(rows, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1) if words else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for key, text in rows:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= {x for x in windows[w] if x is not None}
        ids = ",".join(sorted(map(str, found)))
        out.append((key, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


def bench(spark, items):
    return spark.createDataFrame([(*item, 1) for item in items], "item_id long, text string, n_words int")


def test_like_the_model(spark):
    rng = random.Random(4)
    items = [(r[0], r[1]) for r in real_rows("benchmark")]
    items += [(900, None), (901, ""), (902, "..."), (903, "one two three"), (904, "Of"), (None, prose(1, 40)), (905, prose(2, 9))]
    items += [items[0], (906, items[1][1]), (907, " ".join(["so"] * 15)), (908, "a b a b a b a b a b a b")]
    rows = [(r[0], r[1]) for r in awkward()] + [(1000 + r[0], r[1]) for r in real_rows()]
    for k in range(80):
        source = words_of(rng.choice(items)[1]) or ["x"]
        size = rng.randrange(5, 25)
        at = rng.randrange(max(1, len(source) - size))
        passage = " ".join(source[at : at + size])
        rows.append((3000 + k, f"{prose(k, rng.randrange(30))} {passage.upper()}, {prose(k + 500, rng.randrange(30))}"))
    rows += [(4000, " ".join(["so"] * 12)), (4001, "b a b a b a b a b a b a"), (4002, "one-two three; ONE two")]
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    found = contamination_report(docs, bench(spark, items)).collect()
    wanted = model(rows, items)
    assert order(found) == order(wanted)
    assert 20 < sum(r[-1] for r in wanted) < len(wanted)


def test_empty_tables(spark):
    docs = frame(spark, awkward())
    none = contamination_report(docs, bench(spark, [])).collect()
    assert len(none) == len(awkward()) and not any(r.contaminated for r in none)
    assert contamination_report(spark.createDataFrame([], SCHEMA), bench(spark, [(1, prose(1, 30))])).collect() == []
