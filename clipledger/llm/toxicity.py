"""Toxicity from a weighted lexicon, matched by Aho-Corasick in folded text.

The lexicon is learned: word beginnings and whole words that toxic documents hold and others don't.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import give_back, stage, text_key, text_or_empty

#: Labelled rows to learn from, at most: those with the smallest hash of doc_id.
MAX_LABELLED = 200_000
#: Toxic texts an entry must occur in.
MIN_TEXTS = 3
#: Log-odds an entry must reach.
MIN_WEIGHT = 2.0
#: Texts whose candidates a task counts before it passes them on.
TOGETHER = 1000
#: Clean texts, without a toxic one, that make a phrase an exception.
MIN_EXCEPTION = 3
#: Parts of the labelled rows; a lexicon without a part measures the part for the curve.
FOLDS = 5
#: Lengths of word beginnings that may become entries.
PREFIXES = range(3, 9)
#: Characters of a word that are looked at where signs end it.
LONGEST = 64
#: Powers of the number of words that the sum of weights may be divided by.
POWERS = (0.0, 0.25, 0.5, 0.75, 1.0)

# Characters that look like Latin letters.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ӏ": "l", "ɡ": "g", "ո": "n", "ս": "u", "α": "a", "ο": "o", "ρ": "p",
    "ν": "v", "υ": "u", "ι": "i", "κ": "k", "τ": "t", "ε": "e", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ℓ": "l",
}
# Digits and signs written for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_LETTER = r"[^\W\d_]"
#: Signs at a word's end, and what stands before them up to its beginning. The end is looked for first: it is rare.
_SIGNED = re.compile(r"[013457@$!](?![\w@$!])")
_BEFORE = re.compile(r"[\w@$!]*$")
_IN_WORD = re.compile(rf"(?<={_LETTER})[013457@$!]+(?={_LETTER})|(?<![\w@$!])[013457@$]{{1,2}}(?={_LETTER})")
_INVISIBLE = re.compile("[­​-‍⁠﻿]")
_ODD = re.compile("[" + "".join(_LOOKALIKES) + "Ａ-Ｚａ-ｚ]")
_ALIKE = re.compile(r"(?<!\w)[" + "".join(_LOOKALIKES) + r"]{4,}(?!\w)")
_FOLDED = str.maketrans(_LOOKALIKES | {chr(0xFF41 + k): chr(97 + k) for k in range(26)})
_SPOKEN = str.maketrans(_DIGITS)
_GAPS = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Lower case, look-alike letters as Latin, digits inside words as letters, all else as single blanks around words."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
        if _ODD.search(text):
            # Only in words that also hold Latin letters, or whole Cyrillic and Greek texts would turn into noise.
            text = re.sub(r"\w+", lambda m: m[0].translate(_FOLDED) if re.search("[a-zａ-ｚ]", m[0]) else m[0], text)
    text = _IN_WORD.sub(lambda m: m[0].translate(_SPOKEN), text)
    return f" {_GAPS.sub(' ', text).strip()} "


def readings(text: str) -> list[str]:
    """What words with signs at their end, and words wholly in look-alike letters, may stand for; of four letters or more."""
    text = text.lower()
    found = []
    for m in _SIGNED.finditer(text):
        since = max(m.start() - LONGEST, 0)
        before = _BEFORE.search(text, since, m.end())
        if before[0][0].isalpha() and (before.start() > since or not since):
            found.append(before[0].translate(_SPOKEN))
    if not text.isascii() and _ODD.search(text):
        found += [word for m in _ALIKE.finditer(text) if (word := m[0].translate(_FOLDED)).isascii()]
    return [word for word in found if len(word) > 3]


def _candidates(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        for size in PREFIXES:
            if len(word) > size:
                found.add(f" {word[:size]}")
    return found


@dataclass
class Lexicon:
    """Entries begin with a blank (a word's beginning); those of whole words end with one, too."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    power: float = 0.5
    slope: float = 1.0
    intercept: float = 0.0

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (entry, weight))
        if len(machine):
            machine.make_automaton()
        return machine


def matches(folded: str, machine) -> dict[int, tuple[str, float]]:
    """Where a word with an entry begins (its blank), and the entry with the largest weight there."""
    found: dict[int, tuple[str, float]] = {}
    if len(machine):
        for end, (entry, weight) in machine.iter(folded):
            at = end - len(entry) + 1
            if at not in found or weight > found[at][1]:
                found[at] = entry, weight
    return found


def phrases(folded: str, at: int) -> list[str]:
    """The word that begins after ``at`` with its left and with its right neighbour."""
    end = folded.index(" ", at + 1)
    out = []
    if at > 0:
        out.append(folded[folded.rindex(" ", 0, at) + 1 : end])
    if end + 1 < len(folded):
        out.append(folded[at + 1 : folded.index(" ", end + 1)])
    return out


def evidence(text: str, machine, exceptions: frozenset[str]) -> tuple[float, int]:
    """Sum of weights of the different entries found outside exception phrases, and the number of words."""
    folded = fold(text)
    words = folded.count(" ") - 1
    found: dict[str, float] = {}
    for at, (entry, weight) in matches(folded, machine).items():
        if entry not in found and not (exceptions and any(phrase in exceptions for phrase in phrases(folded, at))):
            found[entry] = weight
    for word in readings(text):
        for entry, weight in matches(f" {word} ", machine).values():
            found[entry] = weight
    return sum(found.values()), max(words, 0)


def _feature(total: np.ndarray, words: np.ndarray, power: float) -> np.ndarray:
    return total / np.maximum(words, 1) ** power


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Slope, intercept and log-likelihood of a logistic curve, by Newton's method with a weak pull to 0."""
    a, b, pull = 0.0, 0.0, 1e-2
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((y - p) * x).sum() - pull * a, (y - p).sum() - pull * b])
        h = np.array([[(w * x * x).sum() + pull, (w * x).sum()], [(w * x).sum(), w.sum() + pull]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))), 1e-9, 1 - 1e-9)
    return float(a), float(b), float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """text and toxic (0 or 1) of labelled documents outside the held-out third; of doc_ids with one text, one.

    ``max_labelled`` bounds how many labelled rows are used. Rows with a null doc_id or label are left out; a doc_id with several
    labels counts as toxic if one says so, and its repeated rows all stay.
    """
    sample = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    texts = docs.where("text is not null").select("doc_id", "text")
    chosen = (
        # At most max_labelled rows of twelve bytes are broadcast.
        texts.join(F.broadcast(sample), "doc_id")
        .groupBy(text_key().alias("key"))
        .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    return texts.join(F.broadcast(chosen.limit(max_labelled)), "doc_id").select("text", "toxic")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _surprise(bad: Column, good: Column, toxic: int, clean: int) -> Column:
    """Likelihood ratio of an entry's share among toxic and among clean texts against one share for both (G squared)."""

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, share = toxic + clean, (bad + good) / (toxic + clean)
    with_it = term(bad, share * toxic) + term(good, share * clean)
    rest = n * (1 - share)
    return 2 * (with_it + term(toxic - bad, rest * toxic / n) + term(clean - good, rest * clean / n))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Lexicon:
    """Entries by log-odds, exception phrases, and the curve from evidence to score.

    An entry must be so unevenly spread that chance would make less than one such among all that were tried, however many
    those are. The curve is fitted to evidence by lexicons that were learned without the text at hand. Without toxic labels
    the lexicon is empty and every score is the smoothed share of toxic labels.
    """
    # Bounded by max_labelled; read four times below.
    part = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(FOLDS)).cast("int").alias("part")
    train = stage(training_rows(docs, labels, max_labelled).select("text", "toxic", part), "labelled")
    sizes = {(r["part"], r["toxic"]): r["n"] for r in train.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}

    def total(label: int, without: int | None) -> int:
        return sum(n for (one, toxic), n in sizes.items() if toxic == label and one != without)

    lexicon = Lexicon(slope=0.0, intercept=float(np.log((total(1, None) + 1) / (total(0, None) + 1))))
    if not total(1, None):
        return lexicon

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for one, some in batch.groupby("part"):
                for at in range(0, len(some), TOGETHER):
                    bad, good = Counter(), Counter()
                    for text, toxic in zip(some["text"].iloc[at : at + TOGETHER], some["toxic"].iloc[at : at + TOGETHER]):
                        (bad if toxic else good).update(_candidates(fold(text)))
                    # An entry that no toxic text of the batch has is needed for its clean count all the same.
                    entries = list(bad.keys() | good.keys())
                    yield pd.DataFrame(
                        {"entry": entries, "part": one, "bad": [bad[e] for e in entries], "good": [good[e] for e in entries]}
                    )

    def without(column: str, one: int) -> Column:
        return F.sum(F.when(F.col("part") != one, F.col(column)).otherwise(0)).alias(f"{column}_{one}")

    counted = (
        train.mapInPandas(count, "entry string, part int, bad long, good long")
        .groupBy("entry")
        .agg(
            F.sum("bad").alias("bad"),
            F.sum("good").alias("good"),
            *(without(name, one) for one in range(FOLDS) for name in ("bad", "good")),
        )
        .where(F.col("bad") >= MIN_TEXTS)
    )
    counted = stage(counted, "entries")
    # Twice the logarithm of how many were tried: passed by chance by fewer than one of them.
    least = 2 * float(np.log(max(counted.count(), 2)))
    chosen: list[dict[str, float]] = []
    for one in (None, *range(FOLDS)):
        name = "" if one is None else f"_{one}"
        bad, good, toxic, clean = F.col(f"bad{name}"), F.col(f"good{name}"), total(1, one), total(0, one)
        weight = F.log((bad + 0.5) / (toxic + 1)) - F.log((good + 0.5) / (clean + 1))
        if not toxic:
            chosen.append({})
            continue
        rows = (
            counted.where(bad >= MIN_TEXTS)
            .select("entry", weight.alias("weight"), _surprise(bad, good, toxic, clean).alias("surprise"))
            .where((F.col("weight") >= MIN_WEIGHT) & (F.col("surprise") >= least))
            .collect()  # bounded by the labelled rows
        )
        weights = {row["entry"]: float(row["weight"]) for row in rows}
        # What a shorter beginning says as well needs no entry.
        chosen.append(
            {
                entry: weight
                for entry, weight in sorted(weights.items())
                if not any(weights.get(entry[:size], 0.0) >= weight for size in range(4, len(entry)))
            }
        )
    lexicon.weights = chosen[0]
    parts = [Lexicon(weights=weights) for weights in chosen[1:]]
    _learn_exceptions(train, lexicon, parts)

    @F.pandas_udf("total double, words long")
    def measured(texts: pd.Series, ones: pd.Series) -> pd.DataFrame:
        machines = [one.automaton() for one in parts]
        seen = [evidence(text, machines[one], parts[one].exceptions) for text, one in zip(texts, ones)]
        return pd.DataFrame(seen, columns=["total", "words"])

    # At most max_labelled rows of three numbers.
    seen = train.select("toxic", measured("text", "part").alias("m")).select("toxic", "m.total", "m.words").toPandas()
    seen = seen.sort_values(["toxic", "total", "words"])  # sums of doubles depend on their order
    sums, words, y = (seen[name].to_numpy(dtype=float) for name in ("total", "words", "toxic"))
    best = None
    for power in POWERS:
        slope, intercept, fit = _logistic(_feature(sums, words, power), y)
        if slope >= 0 and (best is None or fit > best[0] + 1e-9):
            best = (fit, power, slope, intercept)
    if best:
        _, lexicon.power, lexicon.slope, lexicon.intercept = best
    return lexicon


def _learn_exceptions(train: DataFrame, lexicon: Lexicon, parts: list[Lexicon]) -> None:
    """Sets the exception phrases of the lexicon, and of those that are learned without a part."""

    weights = [one.weights for one in (lexicon, *parts)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Wherever any of them has an entry, whichever it is.
        machine = Lexicon({entry: 1.0 for entries in weights for entry in entries}).automaton()
        for batch in batches:
            rows = Counter()
            for text, toxic, one in zip(batch["text"], batch["toxic"], batch["part"]):
                folded = fold(text)
                rows.update({(phrase, one, int(toxic)) for at in matches(folded, machine) for phrase in phrases(folded, at)})
            yield pd.DataFrame([(*key, n) for key, n in rows.items()], columns=["phrase", "part", "toxic", "n"])

    def among(toxic: int, without: int | None) -> Column:
        chosen = F.col("toxic") == toxic
        if without is not None:
            chosen &= F.col("part") != without
        return F.sum(F.when(chosen, F.col("n")).otherwise(0))

    options = [None, *range(len(parts))]
    found = (
        train.mapInPandas(count, "phrase string, part int, toxic int, n long")
        .groupBy("phrase")
        .agg(*(((among(0, one) >= MIN_EXCEPTION) & (among(1, one) == 0)).alias(f"is_{k}") for k, one in enumerate(options)))
        .where(" OR ".join(f"is_{k}" for k in range(len(options))))
        .collect()  # bounded by the labelled rows
    )
    for k, one in enumerate((lexicon, *parts)):
        one.exceptions = frozenset(row["phrase"] for row in found if row[f"is_{k}"])


def toxicity_score(lexicon: Lexicon, column: str | Column = "text") -> Column:
    """Score from 0 to 1 of a whole text; null counts as empty, which has no evidence."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = lexicon.automaton()
        for texts in batches:
            seen = [evidence(text, machine, lexicon.exceptions) for text in texts]
            total, words = np.array(seen, dtype=float).reshape(-1, 2).T
            x = lexicon.slope * _feature(total, words, lexicon.power) + lexicon.intercept
            yield pd.Series(1 / (1 + np.exp(-np.clip(x, -30, 30))))
        give_back()

    return score(text_or_empty(column))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every document.

    Repeated rows each give a row; a null doc_id isn't held out; extra columns are ignored; no rows give no rows.
    """
    lexicon = learn(docs, labels)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(lexicon).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
