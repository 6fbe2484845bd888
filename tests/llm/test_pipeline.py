from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from llm_fixtures import SF, make_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from test_neardup import check as check_groups
from test_packing import check as check_pieces
from test_packing import ids_of

from deskloom.llm import fertility, mixing, neardup, queries, secrets


def test_every_stage_against_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" token = 'k3yabcdefgh'"))).otherwise(F.col("text"))
    steps = [docs.withColumn("text", told)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF).cache())
        assert steps[-1].columns == docs.columns
    raw, good, single, masked, mixed = ([tuple(r) for r in s.collect()] for s in steps)

    judged = fertility.judge(fertility.public_vocabularies())()([r[1] for r in raw], [r[2] for r in raw])
    kept = fertility.FIELDS.names.index("kept")
    assert Counter(good) == Counter(r for r, j in zip(raw, judged) if j[kept])

    groups = neardup.near_duplicates(steps[1]).collect()
    check_groups(groups, [r[:2] for r in good])
    stay = {r.doc_id for r in groups if r.kept}
    assert Counter(single) == Counter(r for r in good if r[0] in stay)

    scan = secrets.scanner(*secrets.vocabulary(), secrets.CHARS_PER_TOKEN)
    texts = {r[0]: secrets.redact(r[1], scan(r[1]), "[SECRET]") for r in single}
    assert Counter(masked) == Counter((r[0], texts[r[0]], *r[2:4], len(texts[r[0]])) for r in single)
    assert any(r[1] != texts[r[0]] for r in single)

    copies = {r.doc_id: r.taken // r.size for r in mixing.mix(steps[3]).collect()}
    assert Counter(mixed) == Counter({r: copies[r[0]] for r in masked if copies[r[0]]})

    check_pieces(corpus_pipeline.STAGES[-1][1](spark, steps[-1], SF).collect(), [r[:2] for r in mixed])


def test_last_stage_gives_ids(spark, make_docs):
    rows = corpus_pipeline.STAGES[-1][1](spark, make_docs(odd_rows()), SF).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    texts = {}
    for r in sorted(rows, key=lambda r: r.piece):
        texts.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert texts[7] == ids_of(dict(r[:2] for r in odd_rows())[7])


def test_run_gives_what_the_stages_give(spark):
    rows = queries.QUERIES["pipeline"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    piece = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(piece, rows)) == Counter(map(piece, docs.collect()))


def test_stages_take_odd_and_empty_tables(spark, make_docs):
    for docs in (make_docs(odd_rows()).selectExpr("*", "1 as kept", "2 as length", "3 as sequence_id"), make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            if name != "best_fit_packing":
                assert got.columns == docs.columns
            assert got.count() >= 0
