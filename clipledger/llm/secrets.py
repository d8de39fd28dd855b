"""Secrets in texts: known shapes, and strings that a tokenizer finds as costly as random ones."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clipledger.llm.support import encoding, give_back, text_or_empty

# The three base patterns, and how long a match must be.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "token")

#: Runs that may be random, and how long they are at least.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{20,}={0,2}")
# Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I)
#: What follows a scheme: user-info and host, then a path. Quotes, commas, brackets and blanks end a URL, a query ends its path.
_ENDS = r"""\s"'`,<>()\[\]{}\\|^"""
URL = re.compile(rf"://([^{_ENDS}/?#]*)([^{_ENDS}?#]*)")
#: Characters a token must hold on average for a string to pass as language.
MIN_CHARS_PER_TOKEN = 2.0


def _known(run: str) -> bool:
    """Digests and UUIDs: not secrets, however random they look."""
    return bool(DIGEST.fullmatch(run) or UUID.fullmatch(run))


def _outside_urls(text: str) -> Iterator[tuple[int, int]]:
    """What is left of a text without the hosts and paths of its URLs; user-info and queries are left."""
    at = 0
    for m in URL.finditer(text):
        yield at, m.start()
        host = m.start(1) + m[1].rfind("@") + 1
        yield m.start(1), host
        at = m.end()
    yield at, len(text)


def find_spans(text: str, encode, min_chars_per_token: float = MIN_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every secret, in order; kinds as in ``KINDS``; code points, end exclusive.

    Base kinds may overlap one another. A ``token`` span is reported where no base span overlaps it.
    """
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found = list(base)
    # Of the base spans that begin before a run ends, the one that ends last tells whether any of them meets the run.
    base.sort()
    starts = [start for start, _, _ in base]
    last = list(accumulate((end for _, _, end in base), max))
    for since, to in _outside_urls(text):
        for m in CANDIDATE.finditer(text, since, to):
            start, end, run = m.start(), m.end(), m[0]
            before = bisect_left(starts, end)
            if (before and last[before - 1] > start) or _known(run):
                continue
            if len(run) < min_chars_per_token * len(encode(run)):
                found.append((start, 3, end))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(
    path: str,
    pattern: str,
    column: str | Column = "text",
    min_chars_per_token: float = MIN_CHARS_PER_TOKEN,
) -> Column:
    """struct(n_assign, n_access, n_hex, n_token, base_sha256, spans) of a text; null counts as empty.

    The token-efficiency test: a long run of characters that needs a token for every
    ``min_chars_per_token`` characters or fewer is taken for random, unless it is a digest, a UUID, or in the host or
    path of a URL. Texts are read whole; an empty one has no spans.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_token long, base_sha256 string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoding(path, pattern).encode_ordinary
        for texts in batches:
            rows = []
            for text in texts:
                spans = find_spans(text, encode, min_chars_per_token)
                counts = [sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))]
                base = _joined([span for span in spans if span[1] < 3])
                rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), _joined(spans)))
            yield pd.DataFrame(
                rows, columns=["n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans"]
            )
        give_back()

    return scan(text_or_empty(column))


def redacted(column: str | Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with every span of ``secret_spans(...).spans`` replaced; overlapping spans give one mark. Null stays null."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, joined in zip(texts, found):
            if text is None or not joined:
                out.append(text)
                continue
            parts, at = [], 0
            for start, end in sorted(tuple(map(int, span.split(":")[1:])) for span in joined.split(",")):
                if start >= at:
                    parts += [text[at:start], mark]
                at = max(at, end)
            out.append("".join(parts) + text[at:])
        return pd.Series(out, dtype="object")

    return redact(F.col(column) if isinstance(column, str) else column, spans)
