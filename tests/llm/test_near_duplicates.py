import random
import re

import numpy as np
import pytest

from clipledger.llm import near_duplicates as N
from clipledger.llm.components import connected
from tests.llm.cases import SCHEMA, awkward, frame, prose, real_rows


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def model(rows):
    sets = [plain_set(text) for _, text in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for (key, _), one, mine in zip(rows, sets, label):
        ids = [k for (k, _), x, s in zip(rows, label, sets) if x == mine and k is not None and s]
        out.append((key, len(one), (min(ids) if ids else None) if one else key))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def variants(seed, count=24, words=60):
    """Texts that differ from one another by a few words, around the threshold."""
    rng, base = random.Random(seed), prose(seed, words).split()
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"w{rng.randrange(50)}"
        out.append(" ".join(text[: len(text) - rng.randrange(3)]))
    return out


def links_of(rows):
    """For every row, how many other rows it is linked with; and the pairs of different sets that are linked."""
    sets = [plain_set(text) for _, text in rows]
    counts, pairs = [0] * len(rows), set()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                counts[i] += 1
                counts[j] += 1
                if sets[i] != sets[j]:
                    pairs.add(frozenset((frozenset(sets[i]), frozenset(sets[j]))))
    return counts, pairs


@pytest.mark.parametrize("block_shingles", [200, 3_000_000])
def test_all_links(spark, block_shingles):
    """Every link within and across blocks, copies and repeated rows included; pairs between classes each once."""
    rows = [(r[0], r[1]) for r in awkward()]
    for seed in range(4):
        rows += [(5000 + 100 * seed + k, text) for k, text in enumerate(variants(seed + 30, words=25 + 15 * seed))]
    rows += [(5000, rows[-1][1])] * 3 + [(None, rows[-2][1])] * 2
    random.Random(2).shuffle(rows)
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    counts, pairs = links_of(rows)
    found = N.link_documents(docs, block_shingles=block_shingles, counts=True)
    wanted = [(*one, count) for one, count in zip(model(rows), counts)]
    assert order(found.collect()) == order(wanted)
    numbered = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id long, text string")
    members, linked = N.linked_classes(numbered, block_shingles=block_shingles)
    classes = {r.class_id: frozenset(plain_set(rows[r.doc_id][1])) for r in members.collect() if r.class_id is not None}
    known = [frozenset((classes[r.class_u], classes[r.class_v])) for r in linked.collect()]
    assert set(known) == pairs and len(known) == len(pairs)


def test_words_made_to_collide(spark):
    """Words by the Thue-Morse pattern and its complement: sums of powers modulo 2 ** 64 agree, the words don't."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[bit ^ flip] for bit in bits) for flip in (0, 1))
    rows = [(1, " ".join(one + c for c in "pqrstuv")), (2, " ".join(other + c for c in "pqrstuv"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(N.link_documents(docs).collect()) == [(1, 3, 1), (2, 3, 2)]


def test_codes_keep_the_order_of_counts():
    codes = N._codes(np.arange(1, 200_000))
    assert (np.diff(codes.astype(int)) >= 0).all() and codes[0] == 1 and codes[127] == 128


def test_one_text_of_each_class(spark):
    """Repeated rows and rows without a doc_id don't bring their text along again."""
    rows = [(7, "a b c d e f g h i j k l m n")] * 300 + [(None, "a b c d e f g h i j k l m n o")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen = []
    real = N.stage
    try:
        N.stage = lambda frame_, name: seen.append((name, real(frame_, name))) or seen[-1][1]
        assert {tuple(r) for r in N.link_documents(docs, counts=True).collect()} == {(7, 10, 7, 599), (None, 11, 7, 599)}
    finally:
        N.stage = real
    assert len(seen) > 5


@pytest.mark.parametrize("block_shingles", [300, 3_000_000])
def test_like_the_model(spark, block_shingles):
    rows = [(r[0], r[1]) for r in awkward()]
    rows += [(1000 + r[0], r[1]) for r in real_rows()]
    for seed in range(6):
        rows += [(5000 + 100 * seed + k, text) for k, text in enumerate(variants(seed + 10, words=20 + 12 * seed))]
    random.Random(1).shuffle(rows)
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    found = N.link_documents(docs, block_shingles=block_shingles)
    assert order(found.collect()) == order(model(rows))


def test_a_large_family_is_searched_in_blocks(spark):
    """Three groups of near copies that share shingles without being alike."""
    common = prose(77, 25)
    rows = []
    for group in range(3):
        own = prose(100 + group, 60)
        for k in range(40):
            words = f"{common} {own}".split()
            words[(7 * k) % len(words)] = f"v{k}"
            rows.append((group * 100 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(N.link_documents(docs, block_shingles=500).collect()) == order(model(rows))


def test_search_matches_all_pairs():
    rng = random.Random(3)
    for _ in range(60):
        base = rng.sample(range(1000), 40)
        sets = []
        for _ in range(12):
            one = set(rng.sample(base, rng.randrange(30, 41))) | set(rng.sample(range(2000, 2040), rng.randrange(6)))
            sets.append(np.array(sorted(one), np.uint64))
        label = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if 100 * len(a & b) >= 80 * len(a | b):
                    label = [label[j] if x == label[i] else x for x in label]
        found = list(range(len(sets)))
        for i, j in N.search(sets):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert 100 * len(a & b) >= 80 * len(a | b)
            found = [found[j] if x == found[i] else x for x in found]
        assert len(set(zip(label, found))) == len(set(label)) == len(set(found))


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    rows = connected(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.label for r in rows} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert len(rows) == 101
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_empty(spark):
    assert N.link_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    only = frame(spark, [(1, None, "", 0, "", "", 0), (None, " ", "", 0, "", "", 0)])
    assert order(N.link_documents(only).collect()) == order([(1, 0, 1), (None, 0, None)])


def test_surplus_keeps_one_of_each(spark):
    rows = [(r[0], r[1]) for r in awkward()]
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "row long, doc_id long, text string")
    gone = {r["row"] for r in N.surplus(docs, "row").collect()}
    kept = [i for i in range(len(rows)) if i not in gone]
    linked = model(rows)
    for i in range(len(rows)):
        group = [j for j in range(len(rows)) if linked[j][2] == linked[i][2] and linked[j][1]]
        if linked[i][1] and linked[i][2] is not None:
            assert len([j for j in group if j in kept]) == 1
            assert rows[[j for j in group if j in kept][0]][0] == linked[i][2]
        elif not linked[i][1]:
            assert i in kept
    # A component without any doc_id keeps one row, too; this test used to ask for all of them.
    nameless = [i for i in range(len(rows)) if linked[i][1] and linked[i][2] is None]
    assert len(nameless) == 2 and len([i for i in nameless if i in kept]) == 1
