import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import LONG, ODD, docs_of
from tokenizers import Tokenizer

from changeflow.llm import token_store
from changeflow.llm.token_store import Coder, frequencies, pack_table, read_index, read_pieces, read_tokens, unpack_table, write_tokens
from changeflow.llm.tokens import TokenIds

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_by_word_is_the_whole_text():
    whole, ids = Tokenizer.from_file(PATH), TokenIds(PATH, limit=50)
    assert ids.by_words
    rng = random.Random(13)
    pieces = [
        "The", "thedin", ",", ".", "!!", "it's", "IT'S", "don'T", " ", "\n", "\t", "\x0b", "\x1c", " ", " ", "　", "é", "É", "ñ", "ß", "ẞ", "İ", "ΑΣ", "中文", "½", "²", "٣", "123",
        "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "́", "ª", "µ", "ﬁ", "😀", "a‍b", "\x00", "-", "'", "'s", "K", "Ǆ", "ͅ",
    ]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12)))
        assert np.frombuffer(ids.encode(text.encode()), "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 5000, 70_001])
@pytest.mark.parametrize("alphabet", [1, 2, 300, 49_408])
def test_round_trip_and_checkpoints(n, alphabet):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, alphabet - 1).astype(np.uint16)
    freq = unpack_table(pack_table(frequencies(np.bincount(ids, minlength=1 << 16))))
    assert freq.sum() == 1 << 16 and (freq[ids] > 0).all()
    coder = Coder(freq)
    data = coder.encode(ids, lanes=32, every=8)
    assert (coder.decode(data) == ids).all()
    lanes = max(1, min(32, n // 64))
    for c in range(1, -(-(-(-n // lanes)) // 8)):
        assert (coder.decode(data, checkpoint=c) == ids[c * 8 * lanes :]).all()
    pieces = list(coder.pieces(data))
    assert [at for at, _ in pieces] == list(range(0, n, 8 * lanes))
    assert (np.concatenate([p for _, p in pieces]) == ids).all()


def test_damage_is_noticed_behind_every_checkpoint():
    ids = np.arange(5000, dtype=np.uint16) % 700
    coder = Coder(frequencies(np.bincount(ids, minlength=1 << 16)))
    whole = coder.encode(ids, lanes=16, every=32)
    _, n, lanes, every, marks = token_store.HEAD.unpack_from(whole)
    assert (lanes, marks) == (16, 10)
    head = token_store.HEAD.size
    places = np.frombuffer(whole, "<u4", marks, head)
    stream = head + 8 * marks + 4 * marks * lanes
    for c in range(marks):
        # a word of the stream, the checksum, a state, the place
        for at in (stream + 2 * int(places[c]) + 40, head + 4 * marks + 4 * c, head + 8 * marks + 4 * lanes * c, head + 4 * c):
            data = bytearray(whole)
            data[at] ^= 1
            with pytest.raises(ValueError):
                coder.decode(bytes(data), c, c + 1)
            with pytest.raises(ValueError):
                coder.decode(bytes(data), c)
    for wrong in ((0, marks + 1), (3, 3), (-1, 2), (marks, None)):
        with pytest.raises(ValueError):
            coder.decode(whole, *wrong)
    with pytest.raises(ValueError):
        coder.decode(b"xxxxx" + whole[5:])


def test_more_ids_than_slots_between():
    counts = np.ones(1 << 16, dtype=np.int64)
    counts[0] = 10**12
    assert frequencies(counts).tolist() == [1] * (1 << 16)
    counts[40_000:] = 0
    freq = frequencies(counts)
    assert freq.sum() == 1 << 16 and (freq[:40_000] > 0).all() and (freq[40_000:] == 0).all()


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "GROUP_IDS", 30_000)
    monkeypatch.setattr(token_store, "BLOCK_IDS", 10_000)
    rows = [*ODD, *[(100 + i, f"The text {i}, again.") for i in range(50)], (7, LONG), (99, "x")]
    write_tokens(docs_of(spark, rows), str(tmp_path / "t"), PATH, partitions=5)
    whole = Tokenizer.from_file(PATH)
    ids = lambda t: whole.encode(t or "", add_special_tokens=False).ids + [2]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    got = read_index(spark, str(tmp_path / "t")).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((repr(d), len(ids(t)), crc(ids(t))) for d, t in rows)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    at = 0
    for r in in_order:
        assert r.start == at
        at += r.n_tokens
    pieces = read_pieces(spark, str(tmp_path / "t")).orderBy("first").collect()
    assert len(pieces) > len({(p.part, p.group, p.block) for p in pieces}) > len({(p.part, p.group) for p in pieces})
    at, joined = 0, []
    for p in pieces:
        assert p.first == at
        at += len(p.ids)
        joined += p.ids
    assert all(crc(joined[r.start : r.start + r.n_tokens]) == r.ids_crc32 for r in got) and at == sum(r.n_tokens for r in got)
    assert sorted((repr(r.doc_id), list(r.ids)) for r in read_tokens(spark, str(tmp_path / "t")).collect()) == sorted((repr(d), ids(t)) for d, t in rows)


def test_empty_table(spark, tmp_path):
    write_tokens(docs_of(spark, []), str(tmp_path / "t"), PATH)
    assert read_index(spark, str(tmp_path / "t")).count() == 0
    assert read_pieces(spark, str(tmp_path / "t")).count() == 0
