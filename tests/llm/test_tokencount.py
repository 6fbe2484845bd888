from __future__ import annotations

import public_tokenizers
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import queries, tokencount

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WHOLE = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_match_whole_texts(spark, sample):
    got = {r.doc_id: r for r in queries.op8_tokencount(spark, SF).collect()}
    for doc in sample:
        n = len(WHOLE.encode(doc["text"]))
        row = got[doc["doc_id"]]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(doc["text"].encode()), n, n > 4096)


@settings(max_examples=600, deadline=None)
@example("▁ ▁", 1)
@example("a ▁ b▁ c", 1)
@given(st.text(st.one_of(st.sampled_from("ab, .\n\té日\U0001f600<s>▁"), st.sampled_from(" ▁")), max_size=80), st.integers(1, 20))
def test_parts_count_like_the_whole(text, size):
    parts = list(tokencount.parts_of(text, size))
    assert " ".join(parts) == text
    assert sum(len(WHOLE.encode(p)) for p in parts) == len(WHOLE.encode(text))


def test_odd_rows(make_docs):
    docs = make_docs(odd_rows()).selectExpr("*", "'x' as N_Tokens")
    rows = tokencount.count_tokens(docs, MODEL, limit=100).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        n = len(WHOLE.encode(r["text"] or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 100)
    assert tokencount.count_tokens(docs.limit(0)).count() == 0
