"""Two-tier byte-level BPE against the reference library, and back."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, docs_of

from changeflow.llm.byte_bpe import ByteBpe, MinimalPerfectHash, Remembered, decoded, encoded

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids_of(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def test_hash_is_minimal_and_perfect():
    for n in (1, 2, 3, 50, 5_000):
        keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
        assert sorted(MinimalPerfectHash(keys).slots(keys).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        MinimalPerfectHash(np.array([7, 7], dtype=np.uint64))


def test_every_word_of_the_vocabulary_is_one_id(bpe):
    assert sum(w != "" for w in bpe.word_at) == len(bpe.word_at)
    for slot in range(0, len(bpe.word_at), 97):
        assert bpe.ranks[bpe.word_at[slot].encode()] == bpe.id_at[slot]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab'st  \n\r\t é中文<|>")), max_size=60))
def test_equals_the_library(bpe, library, text):
    ids = bpe.encode_all([text])[0]
    assert ids_of(ids) == library.encode_ordinary(text)
    assert bpe.decoder()(ids) == text.encode()


def test_long_words_and_texts(bpe, library):
    # one pre-token of many bytes, ties between equal pairs, and texts that are read in slices
    texts = ["a" * 5_000, "abab" * 700, "x" + "\n" * 3_000 + "y", "word " * 300_000, "", "<|endoftext|>"]
    got = bpe.encode_all(texts)
    assert [ids_of(x) for x in got] == [library.encode_ordinary(t) for t in texts]


def test_remembered_outcomes_stay_right_when_forgotten():
    seen = []
    r = Remembered(lambda key: seen.append(key) or key.upper(), 3)
    for key in "abcdabcefgha" * 3:
        assert r[key] == key.upper()
    assert len(r) <= 3 and len(r.old) <= 3 and len(seen) > 8


def test_rows(spark, library):
    rows = [*ODD, (11, "퟿ 中文 <|endoftext|>")]
    tokens = encoded(docs_of(spark, rows), PATH, PATTERN)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded) for r in decoded(tokens, PATH, PATTERN).collect()))
    want = sorted((r[0] is None, r[0] or 0, np.array(library.encode_ordinary(r[1] or ""), dtype="<u4").tobytes(), (r[1] or "").encode()) for r in rows)
    assert [tuple(map(lambda x: bytes(x) if isinstance(x, bytearray) else x, g)) for g in got] == want


def test_empty_table_and_null_ids(spark):
    assert encoded(docs_of(spark, []), PATH, PATTERN).count() == 0
    back = decoded(spark.createDataFrame([(1, None), (2, bytearray())], "decoded long, ids binary"), PATH, PATTERN)
    assert [(r.ids, r.decoded) for r in back.collect()] == [(None, None), (b"", b"")]


def test_query_decodes_to_the_texts(spark):
    from changeflow.llm.queries import QUERIES

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op11_byte_bpe"](spark, "/root/testdata/sf0.001").collect():
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
