import math
import zlib

import pytest

from clipledger.llm import toxicity as T
from tests.llm.cases import SCHEMA, awkward, frame, real_rows


def split(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def corpus(count=240):
    """Documents of harmless words, every fourth with a word that only toxic ones have."""
    words = "river stone table garden window letter winter bridge candle market".split()
    rows, labels = [], []
    for k in range(count):
        text = [words[(k * 7 + j * (k % 9 + 1)) % 10] + "abcdefg"[(k + j) % 7] for j in range(20 + k % 30)]
        toxic = k % 4 == 0
        if toxic:
            text[5] = text[-3] = "Grumbulous" if k % 8 else "grumbulish"
        elif k % 5 == 0:
            text[3:5] = ["vexing", "matter"]
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return T.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def scores(spark, lexicon, texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r.s for r in docs.select("doc_id", T.toxicity_score(lexicon).alias("s")).orderBy("doc_id").collect()]


def plain_score(lexicon, text):
    """The score by a loop over words and entries."""
    words, found = T.fold(text or "").split(), {}

    def best(word):
        fits = [
            (-weight, len(entry), entry)
            for entry, weight in lexicon.weights.items()
            if (word == entry.strip() if entry.endswith(" ") else word.startswith(entry.strip()))
        ]
        return min(fits)[2] if fits else None

    for k, word in enumerate(words):
        entry = best(word)
        phrases = [" ".join(words[k - 1 : k + 1])] * (k > 0) + [" ".join(words[k : k + 2])] * (k + 1 < len(words))
        if entry and not lexicon.exceptions.intersection(phrases):
            found[entry] = lexicon.weights[entry]
    for word in T.readings(text or ""):
        entry = best(word)
        if entry:
            found[entry] = lexicon.weights[entry]
    x = lexicon.slope * sum(found.values()) / max(len(words), 1) ** lexicon.power + lexicon.intercept
    return 1 / (1 + math.exp(-min(max(x, -30), 30)))


def test_like_a_plain_scorer(spark, learned):
    texts = [r[1] for r in awkward()] + [text for _, text in corpus()[0]]
    texts += ["grumbulous grumbulous", "grumbul0us grumbulou5 xx grumb", "stone grumbulish$ table", "grumbulou5, a b", None]
    for found, text in zip(scores(spark, learned, texts), texts):
        assert abs(found - plain_score(learned, text)) < 1e-9


def test_signs_at_the_end_and_whole_words_in_other_letters():
    assert T.readings("that hat3 a55 slu7! abcd3 mp3 сосо Москва") == ["hate", "sluti", "abcde", "coco", "mockba"]


def test_lexicon(learned):
    assert any("grumbulous".startswith(entry.strip()) for entry in learned.weights)
    assert all(not "river".startswith(entry.strip()) for entry in learned.weights)


def test_scores(spark, learned):
    plain = "the river and the stone table by the garden window in winter " * 3
    texts = [
        plain,
        plain + "grumbulous",
        plain.replace("stone", "GRUMBULOUS"),
        plain.replace("stone", "grumbul0us"),  # digit
        plain.replace("stone", "gr\u0443mbul\u043eus").replace("\u0443", "u"),  # Cyrillic o
        plain.replace("stone", "grum\u200bbulous"),  # zero width
        plain.replace("stone", "grumbulous$$$"),
        None,
        "",
    ]
    found = scores(spark, learned, texts)
    assert found[0] < 0.5 and found[7] == found[8] < 0.5
    assert all(score > found[0] for score in found[1:7])
    assert all(0 <= score <= 1 for score in found)


def test_longer_texts_dilute(spark, learned):
    if learned.power:
        short, long = scores(spark, learned, ["a grumbulous b", "a grumbulous b " + "river " * 500])
        assert short >= long


def test_exception_phrases(spark):
    """A toxic word in a fixed phrase of clean documents doesn't count there."""
    rows, labels = corpus()
    rows += [(1000 + k, f"stone grumbulous bridge river {'table ' * (k % 7)}garden") for k in range(30)]
    labels += [(1000 + k, 0) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = T.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "stone grumbulous" in lexicon.exceptions
    machine = lexicon.automaton()
    assert T.evidence("stone grumbulous bridge", machine, lexicon.exceptions)[0] == 0
    assert T.evidence("winter grumbulous candle", machine, lexicon.exceptions)[0] > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.createDataFrame([(r[0], r[1]) for r in real_rows(sf_dir=sf)], "doc_id long, text string")
    labels = [(r[0], r[2]) for r in real_rows("labels", sf)]
    out = T.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == 1000 and all(r.held_out == split(r.doc_id) for r in out)
    known = dict(labels)
    rows = [(known[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in known]
    hits = sum(a and b for a, b in rows)
    assert sum(a == b for a, b in rows) / len(rows) >= 0.95
    assert sum(not a and b for a, b in rows) == 0 and hits > 0


def test_held_out_labels_are_not_used(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    flipped = [(k, 1 - t if split(k) else t) for k, t in labels]
    make = lambda rows: T.learn(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert make(labels) == make(flipped)


def test_awkward_and_empty(spark, learned):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (9, 1), (9, 0)], "doc_id long, toxic int")
    out = T.score_documents(frame(spark, awkward()), labels).collect()
    assert len(out) == len(awkward()) and all(0 <= r.score <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in T.score_documents(frame(spark, awkward()), none).collect()} == {0}
    assert T.score_documents(spark.createDataFrame([], SCHEMA), labels).collect() == []
