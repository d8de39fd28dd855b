import tiktoken

from clipledger.llm import token_counts as C
from clipledger.llm.queries import vocabulary
from clipledger.llm.support import rank_table
from tests.llm.cases import SCHEMA, awkward, frame, real_rows

PATH, PATTERN = vocabulary()


def test_like_the_model(spark):
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=rank_table(PATH), special_tokens={})
    rows = [(r[0], r[1]) for r in awkward()] + [(1000 + r[0], r[1]) for r in real_rows()]
    lengths = [len(plain.encode_ordinary(text or "")) for _, text in rows]
    limits = C.token_counts(frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows]), PATH, PATTERN).cache()
    found = limits.collect()
    assert sorted(r.n_tokens for r in found) == sorted(set(lengths))
    for r in found:
        n = r.n_tokens
        assert (r.documents, r.tokens) == (lengths.count(n), n * lengths.count(n))
        longer = [x for x in lengths if x > n]
        assert (r.longer_documents, r.longer_tokens) == (len(longer), sum(longer))
        assert r.kept_tokens == sum(min(x, n) for x in lengths) and r.lost_tokens == sum(lengths) - r.kept_tokens
        assert r.rank_from == 1 + sum(x < n for x in lengths) and r.rank_to == sum(x <= n for x in lengths)
    ordered = sorted(lengths)
    for r in C.quantiles(limits, (0.0, 0.25, 0.5, 0.99, 1.0)).collect():
        assert r.n_tokens == ordered[max(1, -(-r.fraction * len(ordered) // 1)).__int__() - 1]
    for limit in (0, 1, 17, 1000, 10**9):
        kept = C.kept_at(limits, limit).first()
        assert tuple(kept) == (len(lengths), sum(lengths), sum(min(x, limit) for x in lengths))


def test_empty(spark):
    limits = C.token_counts(spark.createDataFrame([], SCHEMA), PATH, PATTERN)
    assert limits.collect() == []
    assert tuple(C.kept_at(limits, 5).first()) == (0, 0, 0)
    assert C.quantiles(limits).collect() == []
