"""Language identification in two steps: the family first, then one-versus-one within it.

Features are hashed character n-grams of the lower-cased letters of a text, each word between two blanks.
A linear classifier tells the families apart (one vector per family, the highest score wins); within a
family every pair of its languages has a linear support vector machine of its own, and the language with the
most votes wins, ties by the sum of margins. All are support vector machines trained in numpy by dual coordinate
descent, on the whole texts of at most ``TRAINING_ROWS`` rows in total (the same number per language, by hash
of their id); of these rows, and of no others, the model sees the texts.

Learned are the languages of rows with a language and an id that is not held out: crc32 of the id as text,
modulo 5, is not 0. Neither language, source nor id of a row enters its prediction. A null text or one
without letters is ``und`` with score 0, and so is everything if there is nothing to learn from. A single
language learned is predicted for every text with letters, with score 1. Texts are read whole; repeated
rows get the same prediction each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import add_columns

# Families of languages by ISO 639 code; a language in none is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "da", "sv", "no", "nb", "nn", "is", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "semitic": ("ar", "he", "mt", "am"),
    "indic": ("hi", "ur", "bn", "pa", "mr", "gu", "ne", "si"),
}
BITS = 16
ORDERS = (1, 2, 3)
TRAINING_ROWS = 4000
STRETCH = 1 << 20  # characters handled at once; n-grams across a cut of a longer text do not count
EPOCHS = 30
# What a margin that lacks 1 costs beside the weights' length, and the value of the feature that is always there.
COST, UNIT = 200.0, 0.05
SEED = 5
UNDETERMINED = "und"
FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def held_out(identity: F.Column) -> F.Column:
    """Whether a row is kept from training; rows without an id are."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def grams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, and the text each belongs to; none for a text without letters."""
    letters = [(t or "").lower() for t in texts]
    code = np.frombuffer("\n".join(letters).encode("utf-32-le"), "<u4").astype(np.uint32)
    owner = np.repeat(np.arange(len(letters)), [len(t) + 1 for t in letters])[: len(code)]
    # Runs of anything but letters become one blank; so does the line break between texts.
    known, at = np.unique(code, return_inverse=True)
    is_letter = np.array([chr(c).isalpha() for c in known], bool)[at] if len(code) else np.zeros(0, bool)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    code, owner = np.where(is_letter, code, 32)[keep].astype(np.uint64), owner[keep]
    out, owners = [], []
    for n in ORDERS:
        h = np.full(max(len(code) - n + 1, 0), n, np.uint64)
        for i in range(n):
            h = (h + code[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        same = owner[: len(h)] == owner[n - 1 :] if len(h) else np.zeros(0, bool)
        out.append((h >> np.uint64(64 - BITS))[same].astype(np.int64))
        owners.append(owner[: len(h)][same])
    return np.concatenate(out), np.concatenate(owners)


def scores(texts: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the texts under each column of weights (last row: bias), and which texts have letters."""
    parts = [(i, t[at : at + STRETCH]) for i, t in enumerate(t or "" for t in texts) for at in range(0, len(t), STRETCH)]
    n, total = np.zeros(len(texts), int), np.zeros((len(texts), weights.shape[1]))
    held, start = 0, 0
    for at in range(len(parts) + 1):
        if at == len(parts) or held > STRETCH:
            gram, owner = grams([t for _, t in parts[start:at]])
            owner = np.array([i for i, _ in parts[start:at]], int)[owner]
            n += np.bincount(owner, minlength=len(texts))
            for k in range(weights.shape[1]):
                total[:, k] += np.bincount(owner, weights[gram, k], len(texts))
            held, start = 0, at
        if at < len(parts):
            held += len(parts[at][1])
    return total / np.maximum(n, 1)[:, None] + weights[-1], n > 0


Example = tuple[np.ndarray, np.ndarray]


def example(text: str | None) -> Example:
    """The n-grams of a whole text and what share of them each is."""
    counts = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(text or ""), STRETCH):
        counts += np.bincount(grams([text[at : at + STRETCH]])[0], minlength=1 << BITS)
    index = np.flatnonzero(counts)
    return index.astype(np.uint16), (counts[index] / max(counts.sum(), 1)).astype(np.float32)


def machine(examples: list[Example], sign: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS, tolerance: float = 1e-3) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent; the last weight is the bias.

    It makes least half the squared length of the weights plus, for each example of sign 1 or -1 (0: not of this
    machine), its cost times how much its margin lacks of 1. The bias is the weight of one more feature,
    of value ``UNIT``.
    """
    mine = np.flatnonzero(sign)
    w = np.zeros((1 << BITS) + 1)
    alpha = np.zeros(len(examples))
    square = {i: float(np.square(examples[i][1], dtype=np.float64).sum()) + UNIT * UNIT for i in mine}
    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        furthest = 0.0
        for i in rng.permutation(mine):
            index, value = examples[i]
            slope = sign[i] * (w[index] @ value + w[-1] * UNIT) - 1
            moved = min(max(alpha[i] - slope / square[i], 0.0), cost[i]) - alpha[i]
            if moved:
                alpha[i] += moved
                w[index] += moved * sign[i] * value
                w[-1] += moved * sign[i] * UNIT
                furthest = max(furthest, abs(moved) * square[i])
        if furthest < tolerance:
            break
    w[-1] *= UNIT
    return w


def train(examples: list[Example], signs: list[np.ndarray]) -> np.ndarray:
    """One machine per vector of signs, as columns. Each of its classes has the same cost, however many rows it has."""
    weights = np.zeros(((1 << BITS) + 1, len(signs)), np.float32)
    for k, sign in enumerate(signs):
        many = {s: max((sign == s).sum(), 1) for s in (1, -1)}
        cost = COST * np.abs(sign).sum() / 2 * np.where(sign > 0, 1 / many[1], 1 / many[-1])
        weights[:, k] = machine(examples, sign, cost)
    return weights


class Model:
    """Families, their languages, and the weights of all machines side by side."""

    def __init__(self, examples: list[Example], langs: list[str]):
        self.families: dict[str, list[str]] = {}
        for x in sorted(set(langs)):
            self.families.setdefault(family_of(x), []).append(x)
        self.names = sorted(self.families)
        self.pairs = [(f, a, b) for f in self.names for i, a in enumerate(self.families[f]) for b in self.families[f][i + 1 :]]
        lang = np.array(langs)
        family = np.array([family_of(x) for x in langs])
        filled = np.array([len(x[0]) > 0 for x in examples], int)
        signs = [np.where(family == f, 1, -1) * filled for f in self.names]
        signs += [(np.where(lang == a, 1, 0) - np.where(lang == b, 1, 0)) * filled for _, a, b in self.pairs]
        self.weights = train(examples, signs)

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        if not self.names:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        score, lettered = scores(texts, self.weights)
        langs, sure = [], []
        for row, has in zip(score, lettered):
            if not has:
                langs.append(UNDETERMINED)
                sure.append(0.0)
                continue
            order = np.argsort(-row[: len(self.names)], kind="stable")
            family = self.names[order[0]]
            margin = row[order[0]] - row[order[1]] if len(self.names) > 1 else np.inf
            votes = {x: [0, 0.0] for x in self.families[family]}
            for k, (f, a, b) in enumerate(self.pairs, len(self.names)):
                if f == family:
                    votes[a if row[k] >= 0 else b][0] += 1
                    votes[a][1] += row[k]
                    votes[b][1] -= row[k]
            best = max(votes, key=lambda x: (*votes[x], x))
            if len(votes) > 1:
                margin = min(margin, *(abs(row[k]) for k, p in enumerate(self.pairs, len(self.names)) if best in p[1:]))
            langs.append(best)
            sure.append(float(1 / (1 + np.exp(-2 * min(margin, 20.0)))) if np.isfinite(margin) else 1.0)
        return langs, sure


def least_hashes(rows: DataFrame, by: str, most: F.Column) -> DataFrame:
    """Rows (``by``, doc_id) with the least hashes of their ids: at most ``most`` (a column of ``_n``, the class's
    rows) of each class.

    A class is cut by a hash that leaves it twice as many, and some, before it meets in one task. Classes are as
    few as a model has columns, so their sizes go to every task.
    """
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).withColumn("_most", most)
    hashed = rows.select(by, "doc_id", F.xxhash64("doc_id").alias("_hash")).join(F.broadcast(sizes), by)
    share = (2 * F.col("_most") + 100) / F.col("_n")
    few = hashed.where((F.col("_hash") / F.lit(float(1 << 63)) + 1) / 2 <= share)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_hash", "doc_id"))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_most")).select(by, "doc_id")


def training_rows(docs: DataFrame, rows: int) -> list[tuple[Example, str]]:
    """Examples and languages of at most so many texts in all, evenly by language, by the least hashes of their ids.

    Tasks read the whole texts; what reaches the driver is the n-grams of each, at most 2 ** ``BITS``.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "doc_id", "text")
    ids = labelled.select("lang", "doc_id").distinct()
    named = ids.select("lang").distinct().count()
    chosen = least_hashes(ids, "lang", F.lit(max(rows // max(named, 1), 1)))
    # As many ids as there are training rows at most: a side of known size.
    texts = labelled.join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi")
    fields = T.StructType([T.StructField("_index", T.BinaryType()), T.StructField("_share", T.BinaryType()), T.StructField("_text", T.LongType())])

    def make():
        def compute(these):
            found = [example(t) for t in these]
            return {
                "_index": [i.tobytes() for i, _ in found],
                "_share": [v.tobytes() for _, v in found],
                "_text": [hash_of(t) for t in these],
            }

        return compute

    known = add_columns(texts, fields, make, drop=("text",))
    # Of several texts of one id and language one counts.
    known = known.groupBy("lang", "doc_id").agg(F.min(F.struct("_text", "_index", "_share")).alias("one")).select("lang", "doc_id", "one.*")
    found = sorted(known.collect(), key=lambda r: (r["lang"], r["doc_id"]))
    return [((np.frombuffer(r["_index"], np.uint16), np.frombuffer(r["_share"], np.float32)), r["lang"]) for r in found]


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) >> 1


def fit(docs: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model of the languages of ``docs`` (doc_id, text, lang)."""
    found = training_rows(docs, rows)
    return Model([e for e, _ in found], [x for _, x in found])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from ``text`` alone (replacing such columns)."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.families, model.names, model.pairs))

    def make():
        own = Model.__new__(Model)
        own.weights, own.families, own.names, own.pairs = sent.value
        return lambda texts: dict(zip(FIELDS.names, own.predict(texts)))

    return add_columns(docs, FIELDS, make)
