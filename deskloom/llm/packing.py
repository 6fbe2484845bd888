"""Best-fit packing planned on the histogram of lengths.

Documents become token pieces of at most ``capacity`` tokens. Which lengths share a sequence depends only on
how many pieces have each length, so the plan is made on those counts: lengths in falling order, each
filling the open sequences it fits best (least room left), whole groups of equal sequences at a time. The
plan is a list of runs: pieces of one length and of consecutive ranks go to consecutive sequences. Pieces
then take their planned slots by their rank among the pieces of their length.

The plan does not grow with the data: lengths are at most ``capacity``, a length splits at most two groups
of equal sequences, and a sequence holds at most sqrt(2 * capacity) different lengths. For 1024 that
is under 200,000 runs, less than 10 MB; that and one count per length is all that the driver handles.

A null or empty text is a piece of the end token alone. Repeated rows are documents of their own, each with
its own slots. A document of any length is cut into whole pieces; only the first of them may be shorter.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import Stage, blocks, shuffle_partitions

CAPACITY = 1024
END = 2

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
SLOTS = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


class Vocabulary(NamedTuple):
    """A byte-level vocabulary: the file that says how texts are encoded, its entries and the strings of its added
    tokens; and the same tokens as ranks of byte strings with the pattern that splits texts before merging, if
    there is such a file."""

    file: str
    entries: int
    added: tuple[str, ...]
    ranks: str | None = None
    pattern: str | None = None

    @property
    def kind(self) -> str:
        """The unsigned type that holds every id: two bytes where there are at most 65,536."""
        return "<u2" if self.entries <= 1 << 16 else "<u4"


def vocabulary_of(file: str, ranks: str | None = None, pattern: str | None = None) -> Vocabulary:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return Vocabulary(file, tokenizer.get_vocab_size(), added, ranks, pattern)


def public_vocabulary() -> Vocabulary:
    import public_tokenizers as public

    return vocabulary_of(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def encoder(vocabulary: Vocabulary, kind: str = "<u4") -> Callable[[str], np.ndarray]:
    """A function from a text to its token ids, numbers of the given type.

    Both files give the same ids; ranks are merged faster. Only they know no added tokens, so a text that
    holds the string of one is encoded by the other, which is not loaded before.
    """
    import os

    @cache
    def tokenizer():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(vocabulary.file)

    def by_file(text: str) -> np.ndarray:
        return np.array(tokenizer().encode_batch_fast([text], add_special_tokens=False)[0].ids, kind)

    if vocabulary.ranks is None:
        return by_file
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary.ranks, "rb"))}
    merges = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        return by_file(text) if any(s in text for s in vocabulary.added) else np.array(merges.encode_ordinary(text), kind)

    return encode


def cut(n: int, capacity: int) -> list[int]:
    """Ends of the pieces of a document of n tokens: all full but perhaps the first."""
    return list(range((n - 1) % capacity + 1, n + 1, capacity))


def pieces(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY, kind: str = "<u4") -> DataFrame:
    """Token pieces of ``docs`` (doc_id, text), each with its ids as numbers of a type; see :data:`PIECES`."""
    vocabulary = vocabulary or public_vocabulary()
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *PIECES.fields[1:]])

    def run(batches):
        encode, end = encoder(vocabulary, kind), np.array([END], kind)
        for block in blocks(batches, "text"):
            whole = [np.append(encode(t or ""), end) for t in block.column("text").to_pylist()]
            ends = [cut(len(ids), capacity) for ids in whole]
            starts = [[0, *e[:-1]] for e in ends]
            row = np.repeat(np.arange(len(ends)), [len(e) for e in ends])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row)),
                    pa.array([i for e in ends for i in range(len(e))], pa.int32()),
                    pa.array([x for s in starts for x in s], pa.int64()),
                    pa.array([b - a for s, e in zip(starts, ends) for a, b in zip(s, e)], pa.int64()),
                    pa.array([ids[a:b].tobytes() for ids, s, e in zip(whole, starts, ends) for a, b in zip(s, e)], pa.binary()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over counts.

    Rows of (length, first rank, first sequence, pieces of this length per sequence, offset of the first),
    by length and rank. The piece of rank r goes to sequence ``first + (r - first rank) // per``.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> groups of (first sequence, how many)
    runs, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for free in [r for r in sorted(room) if r >= length] + [capacity]:
            if not left:
                break
            fit = free // length
            if free == capacity:
                groups = [(sequences, -(-left // fit))]
                sequences += groups[0][1]
            else:
                groups = room.pop(free)
            while groups and left:
                first, many = groups.pop()
                full = min(many, left // fit)
                for n, per in ((full, fit), (min(1, many - full) if left - full * fit else 0, left - full * fit)):
                    if n:
                        runs.append((length, rank, first, per, capacity - free))
                        room.setdefault(free - per * length, []).append((first, n))
                        rank, left, first, many = rank + n * per, left - n * per, first + n, many - n
                if many:
                    groups.append((first, many))
            if groups:
                room.setdefault(free, []).extend(groups)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def widened(column: pa.Array, kind: str) -> pa.Array:
    """A binary column of numbers of a type as little-endian unsigned 32-bit numbers."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    numbers = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind).astype("<u4")
    moved = (offsets - offsets[0]) * (4 // np.dtype(kind).itemsize)
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(moved.astype(np.int32)), pa.py_buffer(numbers)])


def place(parts: DataFrame, capacity: int = CAPACITY, ids: str | None = None, kind: str = "<u4") -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset`` (replacing such columns); needs a column ``length``.

    No sequence holds more than ``capacity``, and its pieces lie in it without gaps. The binary column ``ids``, if
    named, holds numbers of the type ``kind`` and comes out with 32-bit ones.
    """
    spark = parts.sparkSession
    stage = Stage(spark)
    # Numbers written with the rows, so that no second reading can deal them otherwise.
    rows = stage(parts.withColumn("_row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    runs = plan(counts, capacity)
    # Ranks within a length, which may be that of most pieces: ranks within slices of it, plus what comes before.
    slice_of = F.pmod(F.xxhash64("_row"), F.lit(8 * shuffle_partitions(spark)))
    rows = rows.withColumn("_slice", slice_of)
    sizes = rows.groupBy("_slice", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_slice", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_slice", "length").orderBy("_row")
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["_slice", "length"])
    kept = [f for f in parts.schema.fields if f.name.lower() not in SLOTS.names]
    ranked = ranked.select(*[f.name for f in kept], (F.col("_rank") + F.col("_before")).alias("_rank"))

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            # Runs are ordered by length, then rank: one key for both.
            width = int(runs[:, 1].max(initial=0)) + int(rank.max(initial=0)) + 2
            at = np.searchsorted(runs[:, 0] * width + runs[:, 1], length * width + rank, side="right") - 1
            along = rank - runs[at, 1]
            slots = [runs[at, 2] + along // runs[at, 3], runs[at, 4] + along % runs[at, 3] * length]
            held = [widened(batch.column(f.name), kind) if f.name == ids else batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*held, *map(pa.array, slots)], names=[*(f.name for f in kept), *SLOTS.names])

    return ranked.mapInArrow(run, T.StructType([*kept, *SLOTS.fields]))


def pack(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Documents packed into sequences: their pieces with ids (32-bit) and places.

    Ids are as narrow as the vocabulary allows until they are placed.
    """
    vocabulary = vocabulary or public_vocabulary()
    return place(pieces(docs, vocabulary, capacity, vocabulary.kind), capacity, "ids", vocabulary.kind)
