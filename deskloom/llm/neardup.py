"""Near-duplicate groups by SuperMinHash, banding, verification on full sets and union-find.

A document's set is its distinct word shingles. SuperMinHash gives every element one random permutation of
the signature's places and a random rank in each; a place keeps the least of what it is offered. The
elements' offers are made step by step, all elements of many documents at once, and a document stops as soon
as no later step can lower any of its places. Its places are correlated, so an estimate from them varies less
than one from independent minima.

Bands of the signature are buckets. ``BANDS`` bands of ``ROWS`` rows miss a pair of similarity 0.8 with a
chance of 7e-6. Links are confirmed on full sets:

1. Texts of equal word sequences are one class, named by its least id.
2. Every class is compared with the best connected class (the hub) of its buckets: most copies link here.
3. Members of buckets that still hold several components are compared with the hub of each such bucket. That
   gives more links, and for every member how it differs from the hub and which differences no other has.
4. What is left are members outside the largest component of a hub's buckets. They meet the others under a bound
   that loses nothing: two sets cannot share the differences that only one of them has. Pairs whose signatures
   agree in less than ``LEAST_AGREED`` of the places (5 standard deviations below 0.8) are not fetched.

No bucket is capped, no group costs more than a few comparisons per member but for pairs that the bound lets
pass, and no pair within a component is formed in the last step.

Components come from union-find within partitions and star contraction between them; neither links nor
components reach the driver.

Texts without words and null texts have an empty set, are linked with nothing and stay. Rows that share an id
are one document, linked by any of its texts, and stay or go together: the groups its texts belong to are one. A
row without an id takes no part: its component is null and it is not marked as kept, but a stage that keeps one
document of each group leaves it in. Texts of any length are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import WORD, Stage, add_columns, blocks

SHINGLE = 5
SIMILAR = 80  # per cent
BANDS, ROWS = 30, 5
PLACES = BANDS * ROWS
LEAST_AGREED = 0.62
# Texts hashed at once: bounds the permutations, one byte for each element and place.
SIGNED_BYTES = 1 << 20

SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("_class", T.BinaryType()),
        T.StructField("_bands", T.ArrayType(T.LongType())),
        T.StructField("_signature", T.BinaryType()),
    ]
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_words(text: str | None, word=re.compile(WORD)) -> list[str]:
    """Words of the text with A-Z, and no other letters, in lower case."""
    return word.findall((text or "").encode().lower().decode())


def shingle_hashes(words: list[str], known: dict[str, int], width: int) -> np.ndarray:
    """The distinct shingles of a word sequence as sorted 64-bit hashes; the whole sequence if it is shorter."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    out = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(len(words), width)):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures of non-empty sets of 64-bit hashes, one row each; values in [0, places)."""
    n = len(sets)
    least = np.full(n * places, np.inf)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    permutation = None
    for step in range(places):
        draw = mix(element + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        rank = (draw >> np.uint64(32)).astype(np.float64) / (1 << 32) + step
        swap = step + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int64)
        if permutation is None:
            place = swap
        else:
            every = np.arange(len(element))
            place = permutation[every, swap].astype(np.int64)
            permutation[every, swap] = permutation[:, step]
        np.minimum.at(least, owner * places + place, rank)
        # A later step offers step + 1 at least: documents whose places are all below that are done.
        open_ = (least.reshape(n, places) >= step + 1).any(axis=1)
        if not open_.any():
            break
        going = open_[owner]
        if permutation is None:
            element, owner, swap = element[going], owner[going], swap[going]
            permutation = np.tile(np.arange(places, dtype=np.uint8), (len(element), 1))
            permutation[np.arange(len(element)), swap] = 0
        elif not going.all():
            element, owner, permutation = element[going], owner[going], permutation[going]
    return least.reshape(n, places)


def signer(width: int, bands: int, rows: int) -> Callable[[list], dict]:
    """A function from texts to the columns of :data:`SIGNED`."""
    import xxhash

    known: dict[str, int] = {}

    def sign(texts: list) -> dict:
        if len(known) > 500_000:
            known.clear()
        words = [normal_words(t) for t in texts]
        sets = [shingle_hashes(w, known, width) for w in words]
        filled = [i for i, s in enumerate(sets) if len(s)]
        values = mix(super_minhash([sets[i] for i in filled], bands * rows).view(np.uint64))
        keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(filled), bands))
        for r in range(rows):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values.reshape(-1, bands, rows)[:, :, r])
        short = (values & np.uint64(0xFF)).astype(np.uint8)
        out = {"n_shingles": [len(s) for s in sets], "_class": [None] * len(texts)}
        out |= {"_bands": [None] * len(texts), "_signature": [None] * len(texts)}
        for at, i in enumerate(filled):
            out["_class"][i] = xxhash.xxh3_128_digest(" ".join(words[i]))
            out["_bands"][i] = keys[at].view(np.int64)
            out["_signature"][i] = short[at].tobytes()
        return out

    return sign


COMPARED = "a long, b long, linked boolean, n long, differences array<long>"


def compare(pairs: DataFrame, texts: DataFrame, width: int, similar: int, differing: bool = False) -> DataFrame:
    """The pairs (a, b) of ids on their full sets, by the texts (id, text) of the ids; see :data:`COMPARED`.

    ``n`` is the size of b's set and ``differences``, if wanted, what only one of the two sets holds.
    """
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    both = both.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")

    def run(batches):
        known: dict[str, int] = {}
        last, kept = None, None
        for block in blocks(batches, "text_b"):
            if len(known) > 500_000:
                known.clear()
            linked, sizes, differences = [], [], []
            for a, b in zip(block.column("text_a").to_pylist(), block.column("text_b").to_pylist()):
                if a != last:  # pairs arrive by their first text
                    last, kept = a, shingle_hashes(normal_words(a), known, width)
                other = shingle_hashes(normal_words(b), known, width)
                either = np.setxor1d(kept, other, assume_unique=True)
                shared = (len(kept) + len(other) - len(either)) // 2
                linked.append(100 * shared >= similar * (len(kept) + len(other) - shared))
                sizes.append(len(other))
                differences.append(either.view(np.int64) if differing else None)
            found = [pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(differences, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [block.column("a"), block.column("b"), *found], names=["a", "b", "linked", "n", "differences"]
            )

    return both.mapInArrow(run, COMPARED)


def _forest(batches):
    """Edges of one partition as stars around the least id of each of its components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in root if find(x) != x]
    for at in range(0, len(stars), 50_000):
        a, b = zip(*stars[at : at + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(id, component) of every id in the links (a, b); a component is named by its least id."""
    edges = stage(links.select("a", "b").mapInArrow(_forest, "a long, b long"))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = state
        # Larger neighbours of a node move to its least neighbour, then smaller ones do.
        ways = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(parent, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(moved.union(parent.select("a", F.col("m").alias("b"))).distinct())


def _agreed(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in enough places."""
    one = classes.select(F.col("id").alias("a"), F.col("_signature").alias("_x"))
    two = classes.select(F.col("id").alias("b"), F.col("_signature").alias("_y"))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("_x", "_y"))
            same = (x == y).reshape(batch.num_rows, -1).mean(axis=1) if batch.num_rows else np.zeros(0)
            passed = (same - 1 / 256) / (1 - 1 / 256) >= least  # one place in 256 agrees by chance
            yield batch.select(["a", "b"]).filter(pa.array(passed))

    return pairs.join(two, "b").join(one, "a").select("a", "b", "_x", "_y").mapInArrow(run, "a long, b long").distinct()


def rooted(parents: DataFrame, stage: Stage) -> DataFrame:
    """(id, component) from one link (a, b) per b to a lesser a: every id follows its parents to the last."""
    groups = stage(parents.select(F.col("b").alias("id"), F.col("a").alias("component"), F.lit(True).alias("moved")))
    while not groups.where("moved").isEmpty():
        above = groups.select(F.col("id").alias("component"), F.col("component").alias("above"))
        further = groups.join(above, "component", "left")
        groups = stage(further.select("id", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved")))
    return groups.drop("moved")


def merged(groups: DataFrame, links: DataFrame, stage: Stage) -> DataFrame:
    """The groups with those joined that the links (a, b) connect."""
    edges = links
    for side in ("a", "b"):
        root = groups.select(F.col("id").alias(side), F.col("component").alias("root"))
        edges = edges.join(root, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    moves = components(edges.where("a <> b").distinct(), stage)
    target = moves.select(F.col("id").alias("component"), F.col("component").alias("to"))
    kept = groups.join(target, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return stage(kept.union(moves))


def _with_hubs(banded: DataFrame, stage: Stage) -> DataFrame:
    """(band, id, hub, weight): the members of buckets of several ids, and the best connected of each bucket.

    An id weighs the sizes of its buckets. Of a group of copies the one most like all others weighs most.
    """
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # Both sides grow with the documents: joined by sorting at any size, not by a broadcast at small ones.
    members = stage(banded.join(shared.hint("merge"), "band"))
    marks = [F.sum(F.xxhash64(F.lit(seed), "id").cast("decimal(38,0)")) for seed in (1, 2)]
    alike = members.groupBy("band").agg(F.struct(F.count(F.lit(1)), F.min("id"), F.max("id"), *marks).alias("mark"))
    # Bands agree about most copies: of buckets with the same members one is enough.
    members = members.join(alike.groupBy("mark").agg(F.min("band").alias("band")), "band", "left_semi")
    weights = members.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = members.join(weights, "id").select("band", "id", F.struct("weight", (-F.col("id")).alias("least")).alias("rank"))
    hubs = weighed.groupBy("band").agg(F.max("rank").alias("hub"))
    return stage(weighed.join(hubs, "band").select("band", "id", (-F.col("hub.least")).alias("hub"), F.col("hub.weight").alias("weight")))


def _unresolved(members: DataFrame, groups: DataFrame, stage: Stage) -> DataFrame:
    """Members of buckets that hold several components, with their component."""
    component = F.coalesce("component", "id").alias("component")
    spans = members.join(groups, "id", "left").select("band", component).groupBy("band")
    several = stage(spans.agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("band"))
    return stage(members.join(several, "band").join(groups, "id", "left").select("band", "id", "hub", component))


def _can_link(similar: int) -> F.Column:
    """Whether two sets may be similar by what is known of each beside their hub.

    Their difference is that of their differences from the hub, of which neither can share what it alone
    has: with d differences each and u of them its own, they share min(d - u) at most.
    """
    shared = F.least(F.col("x.d") - F.col("x.u"), F.col("y.d") - F.col("y.u"))
    apart = F.col("x.d") + F.col("y.d") - 2 * shared
    # similar / 100 of the union in common means that so much of both sizes may differ.
    return (100 + similar) * apart <= (100 - similar) * (F.col("x.n") + F.col("y.n"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    stage = Stage(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    signed = stage(add_columns(texts, SIGNED, lambda: signer(width, BANDS, ROWS), drop=("text",), limit=SIGNED_BYTES))
    classes = signed.where("_class is not null and doc_id is not null").groupBy("_class")
    classes = stage(classes.agg(F.min("doc_id").alias("id"), F.first("_bands").alias("_bands"), F.first("_signature").alias("_signature")))
    members = _with_hubs(classes.select("id", F.explode("_bands").alias("band")), stage)
    # Every text of a class is the same word sequence; ids alone name them from here on.
    involved = members.select("id").distinct()
    full = stage(texts.join(involved.hint("merge"), texts["doc_id"] == involved["id"], "left_semi").select(F.col("doc_id").alias("id"), "text"))

    best = members.where("id <> hub").groupBy(F.col("id").alias("b")).agg((-F.max(F.struct("weight", -F.col("hub")))["col2"]).alias("a"))
    groups = rooted(compare(best.select("a", "b"), full, width, similar).where("linked").select("a", "b").distinct(), stage)

    left = _unresolved(members, groups, stage)
    to_hub = left.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    beside = stage(compare(to_hub, full, width, similar, differing=True))
    groups = merged(groups, beside.where("linked").select("a", "b").distinct(), stage)
    own = beside.select("a", "b", F.explode("differences").alias("element")).groupBy("a", "element")
    own = own.agg(F.min("b").alias("b"), F.max("b").alias("most")).where("b = most").groupBy("a", "b").count()
    known = beside.join(own, ["a", "b"], "left").select(
        F.col("a").alias("hub"), F.col("b").alias("id"), "n", F.size("differences").alias("d"), F.coalesce("count", F.lit(0)).alias("u")
    )
    # An id with several texts is known by none of them: anything may be like it.
    known = stage(known.groupBy("hub", "id").agg(F.max("n").alias("n"), F.max("d").alias("d"), F.min("u").alias("u"), F.count(F.lit(1)).alias("texts")))

    # Buckets of one hub share most members: they meet by hub, each pair once.
    left = _unresolved(left.drop("component"), groups, stage).where("id <> hub").select("hub", "id", "component").distinct()
    left = left.join(known, ["hub", "id"])
    sizes = left.groupBy("hub", "component").count().groupBy("hub").agg(F.max(F.struct("count", "component"))["component"].alias("largest"))
    left = stage(left.join(sizes, "hub"))
    met = left.where("component <> largest").alias("x").join(
        left.alias("y"),
        (F.col("x.hub") == F.col("y.hub"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.largest")) | (F.col("x.id") < F.col("y.id")))
        & ((F.col("x.texts") > 1) | (F.col("y.texts") > 1) | _can_link(similar)),
    )
    met = met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    last = compare(_agreed(stage(met), classes, LEAST_AGREED), full, width, similar).where("linked").select("a", "b")
    groups = merged(groups, last.distinct(), stage)

    groups = merged(groups, _same_document(signed, classes), stage)
    whole = groups.union(groups.select(F.col("component").alias("id"), "component").distinct())
    least = whole.groupBy("component").agg(F.min("id").alias("least"))
    groups = whole.join(least, "component").select("id", F.col("least").alias("component"))
    with_words = signed.where("_class is not null").join(classes.select("_class", "id"), "_class", "left").join(groups, "id", "left")
    with_words = with_words.select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    # A text without words goes with what else its id holds.
    without = signed.where("_class is null").select("doc_id", "n_shingles")
    beside = with_words.join(without.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    without = without.join(beside, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    named = with_words.union(without).select("doc_id", "n_shingles", component)
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _same_document(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that one id has texts in, each to the least of them."""
    held = signed.where("doc_id is not null").join(classes.select("_class", "id"), "_class").select("doc_id", "id").distinct()
    least = held.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most")).where("a < most")
    return held.join(least, "doc_id").where("id > a").select("a", F.col("id").alias("b")).distinct()


def keep_one_of_each(docs: DataFrame, width: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """Rows of ``docs`` whose document is the least of its group, and rows without an id; all columns stay."""
    kept = near_duplicates(docs, width, similar).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi").union(docs.where(docs["doc_id"].isNull()))
