import hashlib
import random
import struct

import pytest
import sentencepiece
from helpers import empty_like, odd_documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from curato.llm import sentencepiece_bpe as S
from curato.llm.common import table

MODEL = S.default_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
BPE = S.tokenizer(MODEL)


def expected(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab eth\n\t▁ "), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_encodes_and_decodes_as_the_library_does(text):
    ids = BPE.encode(text)
    assert ids == LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert BPE.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["x" * 5000, "aaaa" * 999, " " * 300, "=" * 1000, "the" * 2000, "\n" * 50, "😀" * 100])
def test_long_runs_without_spaces(text):
    assert BPE.encode(text) == LIBRARY.encode(text, add_bos=True, add_eos=True)


def test_any_ids_decode_as_the_library_does():
    rng = random.Random(1)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 7))]
        assert BPE.decode(ids) == LIBRARY.decode(ids)
    with pytest.raises(ValueError):
        BPE.decode([32000])


def test_full_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(S, "CACHED_WORDS", 3)
    monkeypatch.setattr(S, "CACHED_PAIRS", 5)
    fresh = S.PrefixBpe(MODEL)
    text = "many different words pass through a very small memory of words and pairs " * 3
    assert fresh.encode(text) == LIBRARY.encode(text, add_bos=True, add_eos=True)


def test_odd_rows_kept_ids_and_empty_table(spark, monkeypatch):
    df = with_clashes(odd_documents(spark), "n_tokens", "ids")
    for limit in (S.OUTPUT_BYTES, 64):
        monkeypatch.setattr(S, "OUTPUT_BYTES", limit)
        rows = S.encode_documents(df, MODEL, keep=("ids", "decoded")).collect()
        got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows), key=str)
        assert got == sorted(((r.doc_id, *expected(r.text or "")) for r in df.collect()), key=str)
        assert all(len(r.ids) == r.n_tokens and LIBRARY.decode(r.ids) == r.decoded for r in rows)
    assert S.encode_documents(empty_like(df), MODEL).count() == 0
    with pytest.raises(ValueError):
        S.encode_documents(df, MODEL, keep=("pieces",))


def test_query_equals_the_library_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    for r in S.op8_sentencepiece(spark, sf).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])
