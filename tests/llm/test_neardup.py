from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import neardup, queries
from deskloom.llm.common import Stage


class Forest(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def set_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def check(rows, docs, width=5):
    """Rows are those of all pairs compared."""
    docs = [(d, t) for d, t in docs if d is not None]
    sets = [(d, set_of(t, width)) for d, t in docs]
    holders, forest = defaultdict(list), Forest()
    for i, (d, s) in enumerate(sets):
        forest.find(d)
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                forest.join(d, sets[j][0])
        for x in s:
            holders[x].append(i)
    want = Counter((d, len(s), forest.find(d), d == forest.find(d)) for d, s in sets)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None) == want


def test_query_matches_brute_force(spark, sample):
    check(queries.op7_neardup(spark, SF).collect(), [(d["doc_id"], d["text"]) for d in sample], width=4)


def grown(rng, words, n):
    return " ".join(rng.choices(words, k=n))


@pytest.mark.parametrize("seed", [8, 9])
def test_groups_chains_and_shared_passages(make_docs, seed):
    """Links that hang on one pair, large groups of copies, and buckets of texts that only share a passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = grown(rng, words, 60)
    texts = [grown(rng, words, rng.randrange(3, 120)) for _ in range(150)]
    texts += [passage + " " + grown(rng, words, rng.randrange(10, 40)) for _ in range(60)]
    base = grown(rng, words, 150).split()
    for _ in range(250):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(150)] = rng.choice(words)
        texts.append(" ".join(copy))
    chain = grown(rng, words, 100).split()
    for _ in range(30):
        for _ in range(2):
            chain[rng.randrange(100)] = rng.choice(words)
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    docs = [(1000 + i, t) for i, t in enumerate(texts)]
    docs += [(5000 + i, texts[i % 9].upper() + "\n") for i in range(100)]
    check(neardup.near_duplicates(make_docs([(d, t, "en", "a") for d, t in docs])).collect(), docs)


def test_odd_rows(make_docs):
    docs = make_docs(odd_rows()).selectExpr("*", "1 as KEPT", "2 as _class", "3 as id")
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(odd_rows())
    check(rows, [(d, t) for d, t, *_ in odd_rows()])
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, False)]
    kept = neardup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([-1, *(r.doc_id for r in rows if r.kept)])
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_ids_with_several_texts_link_their_groups(make_docs):
    """What one id's texts are like is one component, and stays or goes as a whole."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    a, b, c, d = (grown(rng, words, 60) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (9, b), (20, c), (21, d), (21, c), (30, d), (30, "short"), (41, "short"), (9, ""), (41, None), (50, " "), (7, grown(rng, words, 50)), (7, grown(rng, words, 50))]
    got = neardup.near_duplicates(make_docs([(i, t, "en", "a") for i, t in rows])).collect()
    check(got, rows)
    components = {r.doc_id: r.component_id for r in got}
    assert components == {3: 3, 5: 3, 9: 3, 20: 20, 21: 20, 30: 20, 41: 20, 50: 50, 7: 7}
    docs = make_docs([(i, t, "en", "a") for i, t in rows] + [(None, "no id", "en", "a"), (None, a, "en", "a")])
    kept = sorted((r.doc_id or -1, r.text) for r in neardup.keep_one_of_each(docs).collect())
    assert kept == sorted([(3, a), (20, c), (50, " "), (-1, "no id"), (-1, a)] + [r for r in rows if r[0] == 7])


@pytest.mark.parametrize("seed", [21, 22])
def test_repeated_ids_match_brute_force(make_docs, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [grown(rng, words, 40).split() for _ in range(40)]
    rows = []
    for _ in range(300):
        copy = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(40)] = rng.choice(words)
        rows.append((rng.randrange(150), " ".join(copy)))
    check(neardup.near_duplicates(make_docs([(i, t, "en", "a") for i, t in rows])).collect(), rows)


def test_signatures_estimate_and_stop_early():
    rng = np.random.default_rng(1)
    for similar in (0.3, 0.8):
        errors = []
        for _ in range(60):
            n = int(rng.integers(50, 400))
            common = rng.integers(0, 1 << 63, int(n * similar), dtype=np.uint64)
            rest = [rng.integers(0, 1 << 63, (n - len(common)) // 2, dtype=np.uint64) for _ in range(2)]
            x, y = neardup.super_minhash([np.r_[common, r] for r in rest], 150)
            errors.append((x == y).mean() - len(common) / (len(common) + len(rest[0]) + len(rest[1])))
        assert abs(np.mean(errors)) < 0.02
        assert np.std(errors) < np.sqrt(similar * (1 - similar) / 150) * 1.15
    # A signature does not depend on what else is in the batch, and is that of the whole permutations.
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 40, 500)]
    alone = [neardup.super_minhash([s], 150)[0] for s in sets]
    assert (neardup.super_minhash(sets, 150) == np.array(alone)).all()
    assert sorted(np.floor(alone[0])) == list(range(150))


def test_components_of_random_links(spark):
    rng = random.Random(9)
    links = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1400)]
    links += [(10_000 + i, 10_001 + i) for i in range(300)] + [(20_000, 20_000 + i) for i in range(1, 800)]
    links = [(a, b) for a, b in links if a != b]
    forest = Forest()
    for a, b in links:
        forest.join(a, b)
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    got = {r.id: r.component for r in neardup.components(df, Stage(spark)).collect()}
    assert got == {x: forest.find(x) for x in forest if forest.find(x) != x}
