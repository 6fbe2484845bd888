"""Quality rules by tokeniser fertility: what public vocabularies make of a text, held against bands.

A vocabulary trained on ordinary text needs few tokens for ordinary text. Symbol noise and random strings
cost more tokens a character, characters outside the vocabulary fall back to bytes, and text that repeats
itself or hardly does has a token entropy out of the ordinary. Each text gets

* ``chars_per_token``: word characters per token of a byte-level vocabulary for many languages,
* ``byte_share``: share of byte-fallback tokens under a vocabulary that has them (line breaks aside),
* ``token_entropy``: bits per token of the distribution of its tokens under the same vocabulary,

and is kept if all lie in the bands of its language, or where that has none, of its main script.

Chunks of texts met again are not encoded again: the measures are those of the whole text's tokens all the
same (see :class:`Chunks`).

Null and empty texts have no word: counts and measures 0, and they fail the base rules. Texts of any
length are measured whole, runs without a blank too. Repeated rows get the same verdict each.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from collections.abc import Callable
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from deskloom.llm.common import add_columns, keep_rows


class Band(NamedTuple):
    """Accepted ranges; the entropy floor holds from ``ENTROPY_TOKENS`` tokens on."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float
    most_entropy: float


# Bands by language, then by script (the last is for all others). The floor of characters per token lies
# below all ordinary prose of the language and above prose with a symbol attached to every word.
LANGUAGES = {
    "en": Band(1.90, 9.0, 0.20, 3.0, 11.5),
    "de": Band(1.95, 9.0, 0.20, 3.0, 11.5),
    "fr": Band(1.75, 9.0, 0.20, 3.0, 11.5),
    "es": Band(1.75, 9.0, 0.20, 3.0, 11.5),
}
SCRIPTS = {
    "LATIN": Band(1.60, 9.0, 0.30, 3.0, 11.5),
    "CYRILLIC": Band(0.90, 9.0, 0.40, 3.0, 11.5),
    "GREEK": Band(0.60, 9.0, 0.60, 3.0, 11.5),
    "ARABIC": Band(0.60, 9.0, 0.60, 3.0, 11.5),
    "CJK": Band(0.25, 4.0, 0.90, 3.0, 12.5),
    "HIRAGANA": Band(0.25, 4.0, 0.90, 3.0, 12.5),
    "HANGUL": Band(0.25, 4.0, 0.95, 3.0, 12.5),
    "": Band(0.20, 9.0, 0.98, 2.5, 12.5),
}
ENTROPY_TOKENS = 64
# Chunks a task remembers; beyond that it starts anew. Chunks counted in one text.
REMEMBERED, JOINED = 400_000, 512
# Where a text may be cut: spaces between characters that are no white space and not the mark for a space.
SAFE = re.compile(r"(?<=[^\s\u2581]) (?=[^\s\u2581])")
MARKS = re.compile("[\u2581\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BLANKS = bytes(32 if chr(c).isspace() and c < 128 else c for c in range(256))
SYMBOLS = "#*$%&|<>"
WINDOW = 8

FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("chars_per_token", T.DoubleType()),
        T.StructField("byte_share", T.DoubleType()),
        T.StructField("token_entropy", T.DoubleType()),
        T.StructField("script", T.StringType()),
    ]
)


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found at least twice in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # Equal windows have equal hashes: without equal hashes, which is the rule, there is nothing to count.
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    rolled.sort()
    if (rolled[1:] != rolled[:-1]).all():
        return 0
    names: dict[str, int] = {}
    name = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    # Name windows of twice the width by the pair of names of their halves.
    width = 1
    while width < window:
        step = min(width, window - width)
        pair = name[: len(name) - step] * (int(name.max()) + 1) + name[step:]
        name = np.unique(pair, return_inverse=True)[1].reshape(-1)
        width += step
    twice = np.bincount(name)[name] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    raw = text.encode()
    # White space of bytes is what stands between words: the space and the controls from tab to carriage return.
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - (len(raw) - sum(map(len, words))),
        len(raw) - len(raw.translate(None, SYMBOLS.encode())),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


# Letters of ASCII, all of one script; what else is in a text is looked at character by character.
OTHER = bytes(c for c in range(128) if not chr(c).isalpha())
BEYOND = re.compile(r"[^\x00-\x7f]+")


def main_script(text: str, tables: dict[str, str]) -> str:
    """The script most letters of a text belong to, by the first word of their Unicode names; "" without any."""
    latin = len(text.encode("ascii", "ignore").translate(None, OTHER))
    seen: Counter = Counter({"LATIN": latin} if latin else {})
    if not text.isascii():
        for c, n in Counter("".join(BEYOND.findall(text))).items():
            if c not in tables:
                tables[c] = unicodedata.name(c, "").split(" ")[0] if c.isalpha() else ""
            if tables[c]:
                seen[tables[c]] += n
    return max(seen, key=lambda s: (seen[s], s)) if seen else ""


def in_bands(band: Band, n_tokens: int, chars: float, byte_share: float, entropy: float) -> bool:
    if not band.least_chars <= chars <= band.most_chars or byte_share > band.most_bytes:
        return False
    return n_tokens < ENTROPY_TOKENS or band.least_entropy <= entropy <= band.most_entropy


def chunks_of(text: str) -> list[str]:
    """The text cut at its safe spaces: at every space, if none stands beside white space or the mark, or at an end."""
    blanked = text.encode().translate(BLANKS)
    if b"  " in blanked or blanked[:1] == b" " or blanked[-1:] == b" " or not text.isascii() and MARKS.search(text):
        return SAFE.split(text)
    return text.split(" ")


class Chunks:
    """Tokens of the chunks of texts under both vocabularies, remembered within a task.

    A chunk begins at a space between two characters that are neither white space nor the mark that the second
    vocabulary writes for one. Neither vocabulary has a token that goes on across such a place, so a text's
    tokens are those of its chunks; a chunk in the middle of a text is encoded behind a space, which the second
    vocabulary puts there itself.
    """

    def __init__(self, byte_level: str, fallback: str, pattern: str):
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_level, "rb"))}
        self.many = tiktoken.Encoding("many", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=fallback)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.is_byte[self.pieces.piece_to_id("<0x0A>")] = False
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros(0, np.int64)  # tokens of the first vocabulary
        self.starts = np.zeros(1, np.int64)  # where each chunk's tokens of the second begin
        self.ids = np.zeros(0, np.int32)

    def _add(self, counts: list[int], ids: list[list[int]]) -> None:
        self.counts = np.append(self.counts, counts)
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64))
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(ids), np.int32))

    def _many_counts(self, chunks: list[str]) -> list[int]:
        """Tokens of the first vocabulary in chunks behind a space: many chunks in one text where each opens one token."""
        counts: list[int] = []
        for at in range(0, len(chunks), JOINED):
            part = chunks[at : at + JOINED]
            ids = np.array(self.many.encode_ordinary(" " + " ".join(part)), np.int64)
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) == len(part) and begins[0] == 0:
                counts += np.diff(np.append(begins, len(ids))).tolist()
            else:
                counts += [len(self.many.encode_ordinary(" " + c)) for c in part]
        return counts

    def measure(self, texts: list[str]) -> list[tuple[int, int, float, float]]:
        """Per text: tokens of the second vocabulary, of the first, byte share and entropy of the second."""
        if len(self.number) > REMEMBERED:
            self.forget()
        split = [chunks_of(t) for t in texts]
        # The first chunk has no space in front, and the last may end with spaces: both are encoded as they are.
        ends = np.cumsum([len(c) - 1 for c in split])
        inner = list(chain.from_iterable(c[1:] for c in split))
        found = np.fromiter(map(self.number.get, inner, repeat(-1)), np.int64, len(inner))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            known = len(self.number)
            new = list(dict.fromkeys(inner[i] for i in missing))
            self.number.update(zip(new, range(known, known + len(new))))
            self._add(self._many_counts(new), self.pieces.encode(new, num_threads=1))
            found[missing] = [self.number[inner[i]] for i in missing]
        first_ids = self.pieces.encode([c[0] for c in split], num_threads=1)
        out = []
        for c, ids, a, b in zip(split, first_ids, np.append(0, ends), ends):
            here = found[a:b]
            sizes = self.starts[here + 1] - self.starts[here]
            at = np.repeat(self.starts[here] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            whole = np.concatenate([np.array(ids, np.int32), self.ids[at]])
            n_many = len(self.many.encode_ordinary(c[0])) + int(self.counts[here].sum())
            if not len(whole):
                out.append((0, n_many, 0.0, 0.0))
                continue
            share = np.unique(whole, return_counts=True)[1] / len(whole)
            out.append((len(whole), n_many, float(self.is_byte[whole].mean()), float(-(share * np.log2(share)).sum())))
        return out


def measurer(byte_level: str, fallback: str, pattern: str) -> Callable[[list[str], list[int]], list[tuple]]:
    """A function from texts and their word characters to (tokens, characters per token, byte share, entropy) of each."""
    chunks = Chunks(byte_level, fallback, pattern)

    def measure(texts: list[str], word_chars: list[int]) -> list[tuple[int, float, float, float]]:
        return [
            (n, chars / n_many, share, entropy) if n and n_many else (0, 0.0, 0.0, 0.0)
            for (n, n_many, share, entropy), chars in zip(chunks.measure(texts), word_chars)
        ]

    return measure


def judge(vocabularies: tuple[str, str, str]) -> Callable[[], Callable[..., list[tuple]]]:
    """A maker of a function from texts and their languages to rows of :data:`FIELDS`."""

    def make():
        measure, tables = measurer(*vocabularies), {}

        def rows(texts: list, langs: list) -> list[tuple]:
            counts = [base_counts(t) for t in texts]
            worded = [i for i, c in enumerate(counts) if c[0]]
            measured = dict(zip(worded, measure([texts[i] for i in worded], [counts[i][1] for i in worded])))
            out = []
            for i, (text, lang, c) in enumerate(zip(texts, langs, counts)):
                failed = base_failed(c[0], c[4])
                if i not in measured:
                    out.append((*c, failed, False, 0, 0.0, 0.0, 0.0, ""))
                    continue
                script = main_script(text, tables)
                band = LANGUAGES.get(lang) or SCRIPTS.get(script) or SCRIPTS[""]
                out.append((*c, failed, not failed and in_bands(band, *measured[i]), *measured[i], script))
            return out

        return rows

    return make


def public_vocabularies() -> tuple[str, str, str]:
    """The two vocabulary files, and the pattern that splits text before the merges of the first."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )


def measure_quality(docs: DataFrame, vocabularies: tuple[str, str, str] | None = None) -> DataFrame:
    """``docs`` with the columns of :data:`FIELDS`, which replace columns of the same names."""
    rows = judge(vocabularies or public_vocabularies())

    def make():
        run = rows()

        def compute(texts, langs):
            columns = list(zip(*run(texts, langs))) or [[]] * len(FIELDS.names)
            return dict(zip(FIELDS.names, columns))

        return compute

    return add_columns(docs, FIELDS, make, ("text", "lang"))


def keep_quality(docs: DataFrame, vocabularies: tuple[str, str, str] | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`measure_quality` keeps, all columns as they were."""
    rows, at = judge(vocabularies or public_vocabularies()), FIELDS.names.index("kept")

    def make():
        run = rows()
        return lambda texts, langs: [r[at] for r in run(texts, langs)]

    return keep_rows(docs, make, ("text", "lang"))
