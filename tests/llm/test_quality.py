import re
from collections import Counter

from clipledger.llm import quality as Q
from tests.llm.cases import SCHEMA, awkward, frame, prose, real_rows


def model(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, gram in enumerate(grams) if often[gram] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        len(re.findall("[A-Za-z]", text)),
        len(re.findall("[A-Z]", text)),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals")


def verdicts(m):
    n, chars, symbols, dup, repeat, lines, letters, capitals = m
    return (
        n < 10,
        100 * repeat > 20 * n,
        4 * symbols > n,
        10 * dup > 3 * lines,
        2 * chars < 5 * n or chars > 15 * n,
        letters >= 40 and 2 * capitals > letters,
    )


def rows_of():
    rows = [(r[0], r[1]) for r in awkward()] + [(1000 + r[0], r[1]) for r in real_rows()]
    rows += [(3000, f"{prose(1, 30)} {prose(2, 12)} {prose(3, 9)} {prose(2, 12)}"), (3001, "x " * 200), (3002, "A B C D E F " * 2)]
    return rows


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_like_the_model(spark):
    rows = rows_of()
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    found = [
        (r.doc_id, *(r[name] for name in NAMES), r.failed_bits, r.base_failed, r.kept) for r in Q.judge(docs).collect()
    ]
    wanted = []
    for key, text in rows:
        m = model(text)
        bits = sum(1 << at for at, bad in enumerate(verdicts(m)) if bad)
        wanted.append((key, *m, bits, bits & 3 != 0, bits == 0))
    assert order(found) == order(wanted)


def test_policies_and_ablations(spark):
    entries = Q.ledger(frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows_of()])).cache()
    bits = [r.failed_bits for r in entries.collect()]
    kept = [r.kept for r in Q.apply_policy(entries, "base-1").collect()]
    assert sum(kept) == sum(b & 3 == 0 for b in bits)
    for row in Q.ablations(entries, "strict-1").collect():
        bit = 1 << Q.RULE_NAMES.index(row.rule)
        assert row.documents == len(bits)
        assert row.failed == sum(b & bit != 0 for b in bits)
        assert row.only_this == sum(b == bit for b in bits)
        assert row.kept_without == sum(b & ~bit == 0 for b in bits)


def test_rule_bits_are_named_in_order():
    assert [rule.name for rule in Q.rules()] == list(Q.RULE_NAMES)
    assert [rule.bit for rule in Q.rules()] == list(range(len(Q.RULE_NAMES)))


def test_empty_and_native(spark):
    judged = Q.judge(spark.createDataFrame([], SCHEMA))
    assert judged.collect() == []
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
