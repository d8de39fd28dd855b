"""Quality rules as a ledger: every rule is evaluated once per document, policies are masks over its bits.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import text_or_empty

# White space, symbols, and the bounds of the base rules.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger: set where ``failed`` holds. Bits are never given to another rule."""

    bit: int
    name: str
    failed: Column


def rules() -> list[Rule]:
    """All rules, over the measurements of ``measure``."""
    n = F.col("n_words")
    return [
        Rule(0, "few_words", n < MIN_WORDS),
        Rule(1, "repeated_words", F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT),
        # More than one symbol to four words: marked-up or tabular leftovers.
        Rule(2, "symbols", F.col("n_symbols") * 4 > n),
        # More than three lines in ten say what an earlier one said.
        Rule(3, "repeated_lines", F.col("n_dup_lines") * 10 > F.col("n_lines") * 3),
        # Mean word length outside 2.5 to 15 code points.
        Rule(4, "word_length", (F.col("word_chars") * 2 < n * 5) | (F.col("word_chars") > n * 15)),
        # More than half of the letters A-Z in capitals, in texts of 40 letters or more.
        Rule(5, "shouting", (F.col("n_letters") >= 40) & (F.col("n_capitals") * 2 > F.col("n_letters"))),
    ]


#: Versioned policies: the rules each one applies. A published version is never changed.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "strict-1": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting"),
}


def policy_mask(policy: str) -> int:
    bits = {rule: at for at, rule in enumerate(RULE_NAMES)}
    return sum(1 << bits[name] for name in POLICIES[policy])


# Rule names in order of their bits.
RULE_NAMES = ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _covered(positions: Column) -> Column:
    """How many words the windows that start at sorted ``positions`` cover."""
    # A window reaches to the next window's start, or its own end.
    return F.when(F.size(positions) == 0, F.lit(0)).otherwise(
        F.aggregate(
            positions,
            F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last")),
            lambda seen, p: F.struct(
                (seen["n"] + F.least(F.lit(GRAM), p - seen["last"])).alias("n"), p.alias("last")
            ),
            lambda seen: seen["n"],
        )
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as the contract of the base rules has them, and n_lines,
    n_letters, n_capitals. A null or empty text measures 0 throughout. Windows of five words are compared by a
    64-bit hash of their words within one text.
    """
    text = F.col("_text")
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda word: word != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    chars = F.length(text)
    base = docs.select("doc_id", text_or_empty().alias("_text")).select(
        "doc_id",
        F.size(words).alias("_n"),
        F.transform(words, lambda word: F.xxhash64(word)).alias("_hashes"),
        _without(text, SPACE).alias("word_chars"),
        (chars - _without(text, SYMBOLS)).alias("n_symbols"),
        lines.alias("_lines"),
        (chars - _without(text, _LETTERS)).alias("n_letters"),
        (chars - _without(text, _CAPITALS)).alias("n_capitals"),
    )
    hashes = F.col("_hashes")
    windows = F.when(
        F.col("_n") >= GRAM,
        F.transform(
            F.sequence(F.lit(0), F.col("_n") - GRAM),
            lambda at: F.xxhash64(*[F.get(hashes, at + k) for k in range(GRAM)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    gridded = base.select(
        "*",
        F.size("_lines").alias("n_lines"),
        F.size(F.array_distinct("_lines")).alias("_distinct_lines"),
        windows.alias("_windows"),
    ).select("*", F.size(F.array_distinct("_windows")).alias("_distinct_windows"))

    # Only texts with a repeated window go on to find where: sort windows, keep those equal to a neighbour.
    sorted_windows = F.array_sort(
        F.transform(F.col("_windows"), lambda window, at: F.struct(window.alias("w"), at.alias("at")))
    )
    repeated = gridded.select(
        "*",
        F.when(F.col("_distinct_windows") < F.size("_windows"), sorted_windows).alias("_sorted"),
    )
    entry = F.col("_sorted")
    positions = F.array_sort(
        F.transform(
            F.filter(
                F.transform(
                    entry,
                    lambda one, at: F.struct(
                        one["at"].alias("at"),
                        (
                            F.coalesce(F.get(entry, at - 1)["w"] == one["w"], F.lit(False))
                            | F.coalesce(F.get(entry, at + 1)["w"] == one["w"], F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda one: one["twice"],
            ),
            lambda one: one["at"],
        )
    )
    return repeated.select("*", F.when(entry.isNotNull(), positions).alias("_positions")).select(
        "doc_id",
        F.col("_n").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.col("n_lines") - F.col("_distinct_lines")).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("_positions")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_letters").cast("long").alias("n_letters"),
        F.col("n_capitals").cast("long").alias("n_capitals"),
    )


_CAPITALS = "".join(map(chr, range(65, 91)))
_LETTERS = _CAPITALS + _CAPITALS.lower()


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of ``measure`` and ``failed_bits``: a bit per rule, set where it failed.

    One row per document, repeated ones included. Store it once; every policy and study reads it instead of the texts.
    """
    bits = F.lit(0).cast("long")
    for rule in rules():
        bits = bits.bitwiseOR(F.when(rule.failed, F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed_bits", bits)


def apply_policy(entries: DataFrame, policy: str = "strict-1") -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0)


def ablations(entries: DataFrame, policy: str = "strict-1") -> DataFrame:
    """What each rule of a policy does: rule, failed, only_this (kept again if the rule were dropped), kept_without, documents.

    Counts documents per bit pattern first, of which there are few, then sums over patterns.
    """
    mask = policy_mask(policy)
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("documents")
    )
    listed = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.lit(1 << RULE_NAMES.index(name)).cast("long").alias("bit")) for name in POLICIES[policy]]
    )
    per = patterns.select("bits", "documents", F.explode(listed).alias("r"))
    has, alone = F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("bits") == F.col("r.bit")
    return per.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(has, F.col("documents")).otherwise(0)).alias("failed"),
        F.sum(F.when(alone, F.col("documents")).otherwise(0)).alias("only_this"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("documents")).otherwise(0)).alias("kept_without"),
        F.sum("documents").alias("documents"),
    )


def judge(docs: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The ledger with base_failed (a base rule failed) and kept (false if so, else the policy's verdict)."""
    base = F.col("failed_bits").bitwiseAND(F.lit(policy_mask("base-1")).cast("long")) != 0
    judged = apply_policy(ledger(docs), policy).withColumn("base_failed", base)
    return judged.withColumn("kept", F.col("kept") & ~F.col("base_failed"))
