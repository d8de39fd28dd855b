"""Per-expression checks: a JSON or text value per table row, and the expected result as SQL.

Each entry is (table, Spark SQL of the input, expression over it, expected SQL over the table).
The input cycles through the cases of one expression by the row's key and embeds the key or the
row's whole text, so every row has its own answer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.fixtures.raw import table
from clipledger.functions import scalars as S
from clipledger.functions import variants as V


def choose(key: str, *cases: str) -> str:
    """CASE over ``key`` modulo the number of cases; reads the same in both dialects."""
    arms = " ".join(f"WHEN {number} THEN {case}" for number, case in enumerate(cases))
    return f"CASE {key} % {len(cases)} {arms} END"


@dataclass(frozen=True)
class Case:
    table: str
    key: str
    source: str
    result: Callable[[Column], Column]
    expected: str
    is_json: bool = True

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, self.table)
        text = rows.select(
            F.col(self.key).cast("bigint").alias("key"),
            F.expr(self.source).alias("source"),
            *[F.col(name) for name in ("o_custkey", "o_orderdate") if name in rows.columns],
        )
        value = F.parse_json("source") if self.is_json else F.col("source")
        return text.withColumn("value", value).select(
            "key", self.result(F.col("value")).alias("result")
        )

    def oracle(self) -> str:
        return (
            f"SELECT CAST({self.key} AS BIGINT) AS key, {self.expected} AS result "
            f"FROM {self.table}"
        )


K = "o_orderkey"
_TEXT_K = "CAST(o_orderkey AS VARCHAR)"


def _json(*members: str) -> str:
    """concat() of JSON fragments, where {k} stands for the order key."""
    return choose(K, *[f"replace('{member}', '{{k}}', string({K}))" for member in members])


CASES: dict[str, Case] = {
    "first_present": Case(
        "orders",
        K,
        _json('{"a":null,"b":{k}}', '{"a":"","b":{k}}', '{"a":0,"b":{k}}', "{}", "[{k}]",
              '{"b":"{k}"}', '{"a":{},"b":1}'),
        lambda v: V.to_text(V.first_present(v, "a", "b")),
        choose(K, _TEXT_K, "''", "'0'", "NULL", "NULL", _TEXT_K, "'{}'"),
    ),
    "first_truthy": Case(
        "orders",
        K,
        _json('{"a":{},"b":"v{k}"}', '{"a":[],"b":"","c":"v{k}"}', '{"a":"0","b":1}',
              '{"a":false,"b":true}', "{}", '{"a":0,"b":0.0,"c":null}', '{"a":{"x":{k}}}'),
        lambda v: V.to_text(V.first_truthy(V.at(v, "a"), V.at(v, "b"), V.at(v, "c"))),
        choose(K, f"'v' || {K}", f"'v' || {K}", "'0'", "'true'", "NULL", "NULL",
               f"'{{\"x\":' || {K} || '}}'"),
    ),
    "truthy": Case(
        "orders",
        K,
        _json("null", "false", "true", "0", "0.00", "{k}1", '""', '"0"', '"false"', "[]",
              "[0]", "{}", '{"a":null}', '"v{k}"', "-0.0", "0e0"),
        V.truthy,
        f"{K} % 16 IN (2, 5, 7, 8, 10, 12, 13)",
    ),
    "to_int": Case(
        "orders",
        K,
        _json("{k}", '" {k} "', '"+{k}"', "{k}.9", "-{k}.9", '"{k}.5"', "true", '"abc"', "{}",
              '""', "null", '"1e3"'),
        V.to_int,
        "CAST(" + choose(K, K, K, K, K, f"-{K}", "NULL", "1", "NULL", "NULL", "NULL", "NULL",
                         "NULL") + " AS BIGINT)",
    ),
    "epoch_to_utc": Case(
        "orders",
        K,
        choose(K, f"string({K} * 86400)", f"concat('\"', {K} * 60, '\"')",
               f"string(-{K} * 3600)", f"string(253402300799 - {K})",
               f"string(253402300800 + {K})", "'\"soon\"'", f"concat({K}, '.7')"),
        lambda v: S.as_utc_ntz(S.epoch_to_utc(V.to_int(v))),
        choose(
            K,
            f"TIMESTAMP '1970-01-01' + to_days(CAST({K} AS INTEGER))",
            f"TIMESTAMP '1970-01-01' + to_minutes({K})",
            f"TIMESTAMP '1970-01-01' - to_hours({K})",
            f"TIMESTAMP '9999-12-31 23:59:59' - to_seconds({K})",
            "NULL",
            "NULL",
            f"TIMESTAMP '1970-01-01' + to_seconds({K})",
        ),
    ),
    "collected_at": Case(
        "orders",
        K,
        "string(o_orderkey)",
        lambda v: S.as_utc_ntz(S.collected_at(S.from_utc_ntz(F.col("o_orderdate")))),
        "o_orderdate",
    ),
    "author_hash": Case(
        "documents",
        "doc_id",
        choose("doc_id", "text", "''", "NULL", "concat(text, source)"),
        S.author_hash,
        choose("doc_id", "sha256(text)", "NULL", "NULL", "sha256(text || source)"),
        is_json=False,
    ),
    "comment_author": Case(
        "orders",
        K,
        _json('{"user":{"unique_id":"a{k}","uid":"x"}}', '{"user":{"unique_id":"","uniqueId":"x"},"uid":"b{k}"}',
              '{"user":{},"uid":{k}1}', '{"user":"text"}', '{"user":{"uid":{k}1},"uid":"x"}',
              '{"user":null,"uid":""}'),
        lambda v: S.comment_author(V.read(v, S.AUTHOR_SHAPE)),
        choose(K, f"'a' || {K}", f"'b' || {K}", f"{K} || '1'", "NULL", f"{K} || '1'", "NULL"),
    ),
    "overlay_text": Case(
        "documents",
        "doc_id",
        choose(
            "doc_id",
            "to_json(named_struct('stickersOnItem', array(named_struct('stickerText', "
            "array('\\t', concat('\\u00a0', lang, ' ')))), "
            "'contents', array(named_struct('desc', concat('<', text, '>')))))",
            "to_json(named_struct('stickersOnItem', text, 'contents', "
            "array(named_struct('desc', concat(' <', text, '> ')), named_struct('desc', ' '))))",
            "to_json(named_struct('stickersOnItem', array(named_struct('stickerText', text))))",
        ),
        lambda v: S.overlay_text(V.read(v, S.OVERLAY_SHAPE)),
        choose("doc_id", "lang || chr(10) || '<' || text || '>'", "'<' || text || '>'", "NULL"),
    ),
    "hashtags": Case(
        "orders",
        K,
        f"to_json(named_struct('textExtra', array(named_struct('hashtagName', concat('x', {K} % 3)), "
        f"named_struct('hashtagName', concat('x', {K} % 2))), "
        f"'text_extra', if({K} % 7 = 0, null, array(named_struct('hashtagName', '', 'hashtag_name', 'z'))), "
        f"'content_desc_extra', array(named_struct('hashtag_name', concat('x', {K} % 5)))))",
        lambda v: F.array_join(S.hashtags(V.read(v, S.HASHTAG_SHAPE)), ","),
        f"'x' || ({K} % 3) || CASE WHEN {K} % 2 <> {K} % 3 THEN ',x' || ({K} % 2) ELSE '' END "
        f"|| CASE WHEN {K} % 5 <> {K} % 3 AND {K} % 5 <> {K} % 2 THEN ',x' || ({K} % 5) ELSE '' END",
    ),
    "canonical_url": Case(
        "orders",
        K,
        _json('{"author":{"uniqueId":"a{k}"}}', '{"author":{"unique_id":"a{k}"}}',
              '{"author":{"uniqueId":"","unique_id":"x"}}', "{}", '{"author":"text"}',
              '{"author":{"uniqueId":null,"unique_id":{k}1}}'),
        lambda v: S.canonical_url(
            F.col("key").cast("string"),
            V.read(v, S.OWNER_SHAPE),
            F.concat(F.lit("u"), F.col("o_custkey")),
        ),
        "'https://www.tiktok.com/@' || "
        + choose(K, f"'a' || {K}", f"'a' || {K}", "'u' || o_custkey", "'u' || o_custkey",
                 "'u' || o_custkey", f"{K} || '1'")
        + f" || '/video/' || {K}",
    ),
    "parent_comment_id": Case(
        "orders",
        K,
        _json('{"reply_id":"0"}', '{"reply_id":0}', "{}", '{"reply_id":"0","reply_to_reply_id":"{k}"}',
              '{"reply_id":null,"replyId":"{k}"}', '{"reply_to_reply_id":{k}1}', '{"reply_id":""}',
              '{"reply_comment_id":"c{k}"}'),
        lambda v: S.parent_comment_id(V.read(v, S.PARENT_SHAPE)),
        choose(K, "NULL", "NULL", "NULL", "NULL",
               f"CASE WHEN {K} = 0 THEN NULL ELSE {_TEXT_K} END", f"{K} || '1'", "''",
               f"'c' || {K}"),
    ),
    "extract_video_id": Case(
        "orders",
        K,
        choose(K, f"concat('\\t', {K}, ' ')", f"concat('https://t.example/@a/video/', {K}, '?x=1')",
               f"concat('no-id-', {K})", f"concat({K}, '/video/x')"),
        S.extract_video_id,
        choose(K, _TEXT_K, _TEXT_K, "NULL", "NULL"),
        is_json=False,
    ),
    "handle_from_url": Case(
        "customer",
        "c_custkey",
        choose("c_custkey", "concat('https://x/@', c_name, '//')", "concat('https://x/', c_custkey)",
               "''", "NULL", "concat('a@b@', c_name)", "'x/@'"),
        S.handle_from_url,
        choose("c_custkey", "c_name", "NULL", "NULL", "NULL", "c_name", "''"),
        is_json=False,
    ),
    "video_url": Case(
        "orders",
        K,
        choose(K, f"concat(' https://t.example/', {K}, ' ')", f"string({K})",
               f"concat('/video/', {K}, '/')", f"concat('no-id-', {K})"),
        lambda v: S.video_url(v, F.when(F.col("key") % 3 == 0, F.concat(F.lit("u"), F.col("o_custkey")))),
        choose(
            K,
            f"'https://t.example/' || {K}",
            *[f"'https://www.tiktok.com/@' || CASE WHEN {K} % 3 = 0 THEN 'u' || o_custkey "
              f"ELSE 'tiktok' END || '/video/' || {K}"] * 2,
            "NULL",
        ),
        is_json=False,
    ),
    "error_message": Case(
        "pages",
        "page_id",
        choose("page_id", "to_json(named_struct('message', html, 'error', url))",
               "to_json(named_struct('message', '', 'error', html))", "concat(' ', html, ' ')",
               "concat('{\"code\":', page_id, '}')", "concat('[', page_id, ']')", "''"),
        S.error_message,
        choose("page_id", "html", "html", "html",
               "'{\"code\":' || page_id || '}'", "'[' || page_id || ']'", "''"),
        is_json=False,
    ),
    "json_type_name": Case(
        "orders",
        K,
        _json("null", "true", "{k}", "{k}.5", '"v{k}"', '""', '{"a":{k}}', "[]",
              "123456789012345678901{k}", "1e{k}", '"a\\\\n{k}"', "2.0"),
        lambda v: V.type_name(v, preview=True),
        choose(K, "'null'", "'bool'", "'int'", "'float'", f"'str (''v' || {K} || ''')'",
               "'str (empty)'", "'dict'", "'list'", "'int'", "'float'",
               f"'str (''a ' || {K} || ''')'", "'float'"),
    ),
}
