"""Fill-in-middle: documents cut into prefix, middle and suffix at unit boundaries, and put in another order.

A unit is a run of ASCII letters or any other single code point, so a cut never lies within a word. Two
numbers drawn by a hash of the document's id, modulo one more than its units, are the cuts.

A Fenwick tree over fixed blocks of the text's UTF-8 bytes holds, per block, the units and the code points
that begin there. A cut is found by binary lifting: the descent by unit counts passes whole blocks and adds
up their code points on the way, and ends in the block in which the wanted unit begins; only that block is
looked through. So what a cut costs beyond one pass over the bytes is the logarithm of the number of blocks
and one block, whatever the length of the text.

A text that is empty or holds one of the marks stays plain, which makes every other output reversible: the
marks can be found in it again (:func:`restored`). A null text is an empty one and a null id is hashed as no
digits. Repeated rows get the same output each; no rows in, no rows out. Columns named like the new ones are
replaced, others stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import add_columns

# Bytes of a block of the tree.
BLOCK = 2048
SEED = "1"
# Of 100 documents so many are cut, and of 100 cut ones so many have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

FIELDS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def begun(data: np.ndarray, after_letter: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For UTF-8 bytes, where units and where code points begin; ``after_letter``: what stands before is one."""
    points = (data & 0xC0) != 0x80
    lower = data | 0x20
    letters = (lower >= ord("a")) & (lower <= ord("z"))
    goes_on = np.empty_like(letters)
    goes_on[:1] = after_letter
    goes_on[1:] = letters[:-1]
    return points & ~(letters & goes_on), points


class UnitTree:
    """Fenwick tree over the blocks of a text: units and code points that begin in each."""

    def __init__(self, raw: bytes, block: int = BLOCK):
        self.data = np.frombuffer(raw, np.uint8)
        self.block = block
        edges = np.arange(0, len(raw), block)
        self.tree = np.zeros((len(edges) + 1, 2), np.int64)
        if len(edges):
            for i, marks in enumerate(begun(self.data)):
                self.tree[1:, i] = np.add.reduceat(marks, edges, dtype=np.int64)
        step = 1
        while 2 * step <= len(edges):
            # Every node of a level takes in the one below it that ends half way.
            self.tree[2 * step :: 2 * step] += self.tree[step : len(edges) + 1 - step : 2 * step]
            step *= 2
        self.top = step
        self.units = self.before(len(edges))[0]

    def before(self, blocks: int) -> tuple[int, int]:
        """Units and code points in the first so many blocks."""
        units = points = 0
        while blocks:
            units, points = units + int(self.tree[blocks, 0]), points + int(self.tree[blocks, 1])
            blocks &= blocks - 1
        return units, points

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) before the place where so many units have passed."""
        if units >= self.units:
            return len(self.data), self.before(len(self.tree) - 1)[1]
        at = passed = points = 0
        step = self.top
        while step:
            further = at + step
            if further < len(self.tree) and passed + self.tree[further, 0] <= units:
                at, passed, points = further, passed + int(self.tree[further, 0]), points + int(self.tree[further, 1])
            step >>= 1
        first = at * self.block
        held = self.data[first : first + self.block]
        unit, point = begun(held, first > 0 and chr(self.data[first - 1] & 0x7F).isalpha() and self.data[first - 1] < 0x80)
        offset = int(np.flatnonzero(unit)[units - passed])
        return first + offset, points + int(np.count_nonzero(point[:offset]))


def draws(identity: int | None) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers fixed by the id."""
    digits = hashlib.sha256(f"{SEED}:{'' if identity is None else identity}".encode()).hexdigest()
    return tuple(int(digits[8 * i : 8 * i + 8], 16) for i in range(4))


def infilled(text: str | None, identity: int | None, block: int = BLOCK) -> tuple:
    """Values of :data:`FIELDS` for one document."""
    text = text or ""
    raw = text.encode()
    tree = UnitTree(raw, block)
    h1, h2, h3, h4 = draws(identity)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CUT:
        return tree.units, PLAIN, None, None, text
    low, high = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    (a, a_points), (b, b_points) = tree.cut(low), tree.cut(high)
    prefix, middle, suffix = raw[:a].decode(), raw[a:b].decode(), raw[b:].decode()
    if h4 % 100 < SUFFIX_FIRST:
        form, parts = SPM, (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = PSM, (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return tree.units, form, a_points, b_points - a_points, "".join(parts)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the columns of :data:`FIELDS`."""

    def make():
        def compute(texts, ids):
            rows = [infilled(t, i) for t, i in zip(texts, ids)]
            return dict(zip(FIELDS.names, zip(*rows))) if rows else {name: [] for name in FIELDS.names}

        return compute

    return add_columns(docs, FIELDS, make, ("text", "doc_id"))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of. A cut text holds no mark, so the first three are those put in."""
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), 4)
    return (
        F.when(form == PSM, F.concat(part[1], part[3], part[2]))
        .when(form == SPM, F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def digest(filled: DataFrame) -> DataFrame:
    """The outputs, and what is restored from them, as hashes."""
    return filled.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# The same cuts for DuckDB.
ORACLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
units AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS unit,
           ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
           ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4
    FROM texts),
cuts AS (
    SELECT *, len(unit)::BIGINT AS n, least(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) AS low,
           greatest(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM units),
parts AS (
    SELECT *, array_to_string(unit[1:low], '') AS prefix, array_to_string(unit[low + 1:high], '') AS middle,
           array_to_string(unit[high + 1:], '') AS suffix
    FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
