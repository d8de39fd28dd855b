import hashlib
import re
import struct

import pytest
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline as P
from clipledger.llm import near_duplicates, secrets, toxicity
from clipledger.llm.queries import QUERIES, vocabulary
from clipledger.llm.support import encoding, rank_table, tables
from tests.llm import test_decontaminate, test_near_duplicates, test_secrets, test_toxicity
from tests.llm.cases import SMALL, awkward
from tests.oracle import compare, connect

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(r[0] + 5000 if r[0] is not None else None, r[1], "en", "s", len(r[1] or "")) for r in awkward()]
    return tables(spark, SMALL, "documents").unionByName(spark.createDataFrame(odd, COLUMNS))


@pytest.fixture(scope="module")
def stored(spark, docs):
    """What each stage got and gave."""
    out, now = [], P.stage(docs, "documents")
    for name, step in P.STAGES:
        after = P.stage(step(spark, now, SMALL), name)
        out.append((name, now, after))
        now = after
    return {name: ([tuple(r) for r in a.collect()], b.collect(), b.columns) for name, a, b in out}


def test_all_but_the_last_keep_columns(stored):
    for name in list(stored)[:-1]:
        assert sorted(stored[name][2]) == ["doc_id", "lang", "n_chars", "source", "text"]


def test_toxicity_keeps_clean_documents(stored, spark):
    before, after, _ = stored["toxicity"]
    gone = set(before) - {tuple(r) for r in after}
    words = re.compile("idiot|clown|moron|stupid|loser|scum|trash|pathetic|worthless|disgusting")
    assert len(after) > 0.7 * len(before)
    assert all(len(set(words.findall(r[1].lower()))) > 0 for r in gone if r[2] == "en")


def test_toxicity_like_a_plain_scorer(spark, docs):
    """What goes is what a plain loop over words and entries scores from the threshold on."""
    lexicon = toxicity.learn(docs, tables(spark, SMALL, "labels"))
    before = [tuple(r) for r in docs.collect()]
    kept = [tuple(r) for r in P.drop_toxic(spark, docs, SMALL).collect()]
    order = lambda rows: sorted(map(repr, rows))
    assert order(kept) == order(r for r in before if test_toxicity.plain_score(lexicon, r[1]) < P.TOXIC_FROM)


def test_clashing_columns(spark, docs):
    """Columns with names that operators use come through every stage but the last."""
    names = ("n", "a", "b", "key", "spans", "score", "row", "label", "node", "gram", "piece", "block")
    wide = P.stage(docs.limit(40).selectExpr("*", *(f"'x' AS {name}" for name in names)), "wide")
    for name, step in P.STAGES[:-1]:
        wide = P.stage(step(spark, wide, SMALL), name)
        assert sorted(wide.columns) == sorted([*docs.columns, *names])
    assert wide.where(" AND ".join(f"{name} = 'x'" for name in names)).count() == wide.count() > 0
    assert P.STAGES[-1][1](spark, wide, SMALL).count() == wide.count()


def test_one_of_each_component_stays(stored):
    before, after, _ = stored["ngram_jaccard_join"]
    linked = test_near_duplicates.model([r[:2] for r in before])
    components = {x[2] for x in linked if x[1] and x[2] is not None}
    rest = [r for r, x in zip(before, linked) if not x[1]]
    # Components without any doc_id (here each one text) keep one row; this test used to ask for all of them.
    nameless = {r[1] for r, x in zip(before, linked) if x[1] and x[2] is None}
    assert len(after) == len(components) + len(rest) + len(nameless)
    assert {r.doc_id for r in after} >= components


def test_numbers_outlive_another_split_of_the_scan(spark):
    docs = P.stage(tables(spark, SMALL, "documents").repartition(3), "unnumbered")
    linked = near_duplicates.link_documents(docs)
    wanted = linked.where("n_shingles > 0").select("component_id").distinct().count() + linked.where("n_shingles = 0").count()
    out = P.drop_near_duplicates(spark, docs, SMALL)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert out.count() == wanted < docs.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_contaminated_ones_go(stored):
    before, after, _ = stored["benchmark_decontamination"]
    items = [(r[0], r[1]) for r in test_decontaminate.real_rows("benchmark")]
    clean = [r for r, x in zip(before, test_decontaminate.model([r[:2] for r in before], items)) if not x[-1]]
    order = lambda rows: sorted(map(repr, rows))
    assert order(clean) == order(tuple(r) for r in after) and len(clean) < len(before)


def test_secrets_are_marked(stored):
    before, after, _ = stored["secret_scans"]
    assert len(before) == len(after)
    assert not any(test_secrets.base(r.text or "") for r in after)
    assert any("<secret>" in (r.text or "") for r in after)
    assert all(r.n_chars == len(r.text) for r in after if "<secret>" in (r.text or ""))
    same = {tuple(r) for r in after}
    assert all(r in same for r in before if not test_secrets.base(r[1] or ""))
    # All spans are marked, those of the token test too: the text between them stays, in order.
    encode = encoding(*vocabulary()).encode_ordinary
    marked = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in after)
    wanted = []
    for r in before:
        text, parts, at = r[1] or "", [], 0
        for start, _, end in secrets.find_spans(text, encode):
            if start >= at:
                parts += [text[at:start], "<secret>"]
            at = max(at, end)
        wanted.append((r[0] is None, r[0] or 0, "".join(parts) + text[at:]))
    assert marked == sorted(wanted)


def test_encoded(stored):
    before, after, _ = stored["byte_level_bpe"]
    path, pattern = vocabulary()
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=rank_table(path), special_tokens={})
    wanted = []
    for r in before:
        ids = plain.encode_ordinary(r[1] or "")
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        wanted.append((r[0], len(ids), packed, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)[:4]) for r in after)


def test_registered_with_expected_results(spark):
    registered = entry_points.queries()
    assert {*QUERIES, "pipeline"} <= set(registered)
    expected = connect(SMALL)
    for name, sql in entry_points.oracle_sql().items():
        if name in QUERIES:
            difference = compare(registered[name](spark, SMALL), expected, sql)
            assert difference is None, f"{name}: {difference}"


def test_empty_documents(spark):
    now = P.stage(tables(spark, SMALL, "documents").where("false"), "none")
    for name, step in P.STAGES:
        now = P.stage(step(spark, now, SMALL), name)
    assert now.count() == 0
