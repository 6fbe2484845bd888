"""Secret scans: patterns of known kinds, and random strings told by their token efficiency.

The vocabulary of a tokeniser holds what people write often. A string of random characters has hardly any
of it, so it costs many tokens: few characters per token. Runs of 20 or more characters of the alphabets
that keys are written in are candidates, after excluding

* known digests: hexadecimal of the lengths of the common hash functions, and UUIDs,
* identifiers: words, words with a short number behind them and numbers, joined by separators or not, where
  a word's capitals begin parts of ``HUMP`` letters on average, and whose letters look like words by their tokens
  too: letters of one case at random, in one run or in groups, cost as many tokens as other random strings.

Base kinds (``assign``, ``access``, ``hex``) are always reported; of a candidate that overlaps some, every stretch
of ``LEAST`` or more characters outside them is a candidate of its own. Runs of digits alone are numbers, and
identifiers by form. Null and empty texts have no spans. Texts are scanned whole, whatever their length; repeated
rows get the same spans each.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import add_columns

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
# A run shorter than the limit fails whole, so the limit may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
UUID = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
LETTERS = re.compile(r"[A-Za-z]+")
WORDS = re.compile(r"[+/_=-]*((\d+|[A-Za-z]+\d{0,4})([+/_=-]+|$))*")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
HUMP = 3
CHARS_PER_TOKEN = 2.0

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
FIELDS = T.StructType([T.StructField("secrets", T.ArrayType(SPAN))])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def is_known(run: str, wordy: Callable[[list[str]], bool]) -> bool:
    """Whether a candidate is no secret: by its form, and of an identifier by its runs of letters (``wordy``) too."""
    body = run.strip("+/_=-")
    if UUID.fullmatch(body) or DIGEST.fullmatch(body) and len(body) in DIGEST_LENGTHS:
        return True
    if not WORDS.fullmatch(run):
        return False
    parts = PARTS.findall(body)
    return sum(map(len, parts)) >= HUMP * len(parts) and wordy(LETTERS.findall(body))


def scanner(ranks_file: str, pattern: str, least: float) -> Callable[[str | None], list[tuple[str, int, int]]]:
    """A function from a text to its spans (kind, start, end) in code points, by start, then kind."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}
    vocabulary = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def tokens(run: str) -> int:
        return len(vocabulary.encode_ordinary(run))

    def wordy(runs: list[str]) -> bool:
        return sum(map(len, runs)) >= least * sum(map(tokens, runs))

    def is_random(run: str) -> bool:
        return not is_known(run, wordy) and len(run) < least * tokens(run)

    def scan(text: str | None) -> list[tuple[str, int, int]]:
        text = text or ""
        spans = base_spans(text)
        taken = sorted((start, end) for _, start, end in spans)
        at = reach = 0
        for m in CANDIDATE.finditer(text):
            # Candidates come in order: reach is the furthest end of the spans that begin before this ends.
            free = []
            start = max(reach, m.start())
            while at < len(taken) and taken[at][0] < m.end():
                free.append((start, taken[at][0]))
                reach = max(reach, taken[at][1])
                start = max(start, reach)
                at += 1
            free.append((start, m.end()))
            for start, end in free:
                if end - start >= LEAST and is_random(text[start:end]):
                    spans.append(("random", start, end))
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    return scan


def redact(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """The text with every stretch that spans cover replaced by the mask once."""
    out, done = [], 0
    for _, start, end in spans:
        if start > done or not out:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join(out) + text[done:]


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def find_secrets(docs: DataFrame, ranks: tuple[str, str] | None = None, least: float = CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with ``secrets``, the spans of each text (replacing a column of that name)."""
    ranks = ranks or vocabulary()

    def make():
        scan = scanner(*ranks, least)
        return lambda texts: {"secrets": [scan(t) for t in texts]}

    return add_columns(docs, FIELDS, make)


def redact_secrets(
    docs: DataFrame, mask: str = "[SECRET]", ranks: tuple[str, str] | None = None, least: float = CHARS_PER_TOKEN
) -> DataFrame:
    """``docs`` with the mask in place of every secret, and ``n_chars``, where it is a column, to match.

    Every row stays; a null text stays null.
    """
    ranks = ranks or vocabulary()

    def make():
        scan = scanner(*ranks, least)

        def compute(texts):
            return {"text": [t and redact(t, scan(t), mask) for t in texts]}

        return compute

    text = T.StructType([T.StructField("text", T.StringType())])
    clean = add_columns(docs, text, make)
    length = F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))
    return clean.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def joined(spans) -> F.Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]  # noqa: B023
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )
