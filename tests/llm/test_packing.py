from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, folder_of, make_docs, odd_rows, sample  # noqa: F401
from tokenizers import Tokenizer

from deskloom.llm import packing, queries

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@given(st.lists(st.integers(1, 30), min_size=1, max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    runs = packing.plan(dict(Counter(lengths)), 30)
    placed = defaultdict(list)
    for n, count in Counter(lengths).items():
        own = [r for r in runs.tolist() if r[0] == n]
        for rank in range(count):
            _, first, sequence, per, offset = max(r for r in own if r[1] <= rank)
            along = rank - first
            placed[sequence + along // per].append((offset + along % per * n, n))
    for slots in placed.values():
        at = 0
        for offset, n in sorted(slots):
            assert offset == at
            at += n
        assert at <= 30
    assert len(placed) == best_fit_one_by_one(lengths, 30)


def test_plan_stays_small():
    rng = random.Random(2)
    runs = packing.plan({n: rng.randrange(1, 10**9) for n in range(1, 1025)}, 1024)
    assert len(runs) < 200_000


def check(rows, docs):
    """Pieces are the documents, and sequences are whole, gapless and within the limit."""
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for doc_id, text in docs:
        ids = ids_of(text)
        starts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want.append((doc_id is None, doc_id or 0, i, a, b - a, crc))
    assert got == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for slots in sequences.values():
        at = 0
        for offset, n in sorted(slots):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(sequences) == best_fit_one_by_one([r.length for r in rows], 1024)


def test_query_matches_brute_force(spark, sample):
    check(queries.op3_packing(spark, SF).collect(), [(d["doc_id"], d["text"]) for d in sample])


def test_sequences_rebuild_the_texts(spark, sample):
    """What lies at a place of a sequence is the ids of the piece; pieces of a document are its ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs).collect()
    sequences = defaultdict(dict)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id][r.offset] = bytes(r.ids)
    whole = {k: b"".join(v[o] for o in sorted(v)) for k, v in sequences.items()}
    pieces = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        ids = np.frombuffer(whole[r.sequence_id], "<u4")[r.offset : r.offset + r.length]
        pieces[r.doc_id] += ids.tolist()
    assert pieces == {d["doc_id"]: ids_of(d["text"]) for d in sample}


def test_odd_rows(spark, make_docs, folder_of):
    odd = odd_rows() + [(20 + i, t, "en", "a") for i, t in enumerate(ODD_TEXTS)]
    check(queries.op3_packing(spark, folder_of(make_docs(odd))).collect(), [(d, t) for d, t, *_ in odd])
    empty = make_docs(odd).limit(0)
    assert packing.pack(empty).count() == 0
    clashing = packing.pieces(make_docs(odd)).selectExpr("*", "'x' as offset", "1 as _n")
    placed = packing.place(clashing)
    assert placed.columns[-2:] == ["sequence_id", "offset"] and "_n" in placed.columns
    assert placed.count() == clashing.count()


ODD_TEXTS = [
    "  two spaces  between  ",
    " a <|endoftext|> b<|endoftext|>c",
    "tab\t and \n new \r\n lines \x0b \x1c \x85 \xa0 end 　 wide",
    "it's  we'll 'tis  1234567 x1y2 ...!!! ''",
    "\n\n \n a\n \n b ",
]


PARTS = st.sampled_from(["<|endoftext|>", "<|", "'ll", "'S", "  ", "\r\n", "\u3000", "\u2028", "café", "日本", "\U0001f468\u200d\U0001f469", "٣x", "Ⅷ½", "e\u0301"])
TEXTS = st.lists(st.one_of(PARTS, st.text(max_size=8), st.text(st.sampled_from("abAB19'., -\n\t\xa0\x1c\x85"), max_size=12)), max_size=12).map("".join)
VOCABULARY = packing.public_vocabulary()
ENCODE, BY_FILE = packing.encoder(VOCABULARY), packing.encoder(VOCABULARY._replace(ranks=None))


@settings(max_examples=1500)
@given(TEXTS)
def test_ranks_give_the_ids_of_the_file(text):
    assert ENCODE(text).tolist() == BY_FILE(text).tolist() == ids_of(text)[:-1]


def test_every_character_between_others_has_the_ids_of_the_file():
    """Both split texts by classes of characters: one of any class, in each neighbourhood."""
    every = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x3000, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    for around in ("a%sb", "1%s2", " %s", ".%s!", "%s ", "\n%s\n x"):
        for c in every:
            text = around % c
            assert ENCODE(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_are_narrow_until_they_are_placed(spark, make_docs):
    import pyarrow as pa

    assert (VOCABULARY.kind, VOCABULARY._replace(entries=65_537).kind) == ("<u2", "<u4")
    docs = make_docs(odd_rows())
    narrow, wide = packing.pieces(docs, kind="<u2").collect(), packing.pieces(docs).collect()
    assert [np.frombuffer(r.ids, "<u2").tolist() for r in narrow] == [np.frombuffer(r.ids, "<u4").tolist() for r in wide]
    values = [b"\x01\x00\x02\xff", b"", b"\x07\x00"]
    for column in (pa.array(values, pa.binary()), pa.array([b"zz", *values, b"y"], pa.binary()).slice(1, 3)):
        assert [np.frombuffer(v, "<u4").tolist() for v in packing.widened(column, "<u2").to_pylist()] == [[1, 0xFF02], [], [7]]
    assert packing.widened(pa.array([], pa.binary()), "<u2").to_pylist() == []


def test_lengths_that_most_pieces_share(spark):
    parts = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "if(id % 3 = 0, 7L, id % 1024 + 1) as length")
    rows = packing.place(parts).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for slots in sequences.values():
        at = 0
        for offset, n in sorted(slots):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(rows) == 5000
    assert len(sequences) == best_fit_one_by_one([r.length for r in rows], 1024)
