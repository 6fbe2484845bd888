"""Token counts: texts encoded in batches inside Arrow functions that return lengths only.

A batch holds at most ``common.BLOCK_BYTES`` of text, so short texts share a call and a long one does not
share it. A longer text is cut at safe boundaries, single spaces between two other characters but the mark U+2581
that the vocabulary writes for a space: no piece of it has a space after another character, so no merge crosses such a place, and the next part,
whose first piece gets a space in front, counts as it does in the whole. Vocabularies of which this does
not hold are not cut for.

Null and empty texts have 0 bytes and 0 tokens. Texts of any length are counted whole; one without a safe
boundary is encoded in one call. Repeated rows get the same counts each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from deskloom.llm.common import add_columns

PART_CHARS = 1 << 16
SAFE = re.compile("(?<=[^ \u2581]) (?=[^ \u2581])")
FIELDS = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
)


def can_cut(pieces) -> bool:
    """Whether single spaces are safe boundaries under a sentencepiece model."""
    inner = any("▁" in pieces.id_to_piece(i).lstrip("▁") for i in range(pieces.vocab_size()))
    whole, parts = pieces.encode("a b, c\n d e"), pieces.encode(["a", "b,", "c\n", "d", "e"])
    return not inner and whole == [i for p in parts for i in p]


def parts_of(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text cut at the first safe boundary after every ``size`` characters, without the cut spaces."""
    start = 0
    while cut := SAFE.search(text, start + size) if len(text) - start > size else None:
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def counter(model: str) -> Callable[[list], list[int]]:
    """A function from texts to their numbers of tokens, without begin, end or added special tokens."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    cut = can_cut(pieces)

    def count(texts: list) -> list[int]:
        parts = [list(parts_of(t)) if cut else [t] for t in (t or "" for t in texts)]
        lengths = [len(x) for x in pieces.encode([p for ps in parts for p in ps], num_threads=1)] if parts else []
        ends = np.cumsum([0, *map(len, parts)])
        total = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
        return (total[ends[1:]] - total[ends[:-1]]).tolist()

    return count


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = 4096) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``, which replace such columns."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")

    def make():
        count = counter(model)

        def compute(texts):
            tokens = count(texts)
            return {
                "n_bytes": [len((t or "").encode()) for t in texts],
                "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

        return compute

    return add_columns(docs, FIELDS, make)
