import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from proseframe.llm.coder import CorruptBlock, decode_block, encode_block
from proseframe.llm.packing import attention_cost, pack, pack_block, room_for, sequences
from proseframe.llm.tokenfiles import pack_segment, read_token_files, segment_starts, unpack_segment, with_starts, write_token_files
from proseframe.llm.tokens import WordEncoder, encoder, tokenizer_path
from proseframe.session import shared_dir

LONG = "the quick brown fox and the lazy dog of an old town " * 3000

LIBRARY = Tokenizer.from_file(tokenizer_path())


def truth(text, end=()):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, *end], dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aàÉß'sStT ,.!?<|>\n\t01½²İΣς\x85\x1c\xa0́中😀"), st.characters(exclude_categories=["Cs"])), max_size=20))
def test_ids_are_the_librarys(text):
    assert encoder().encode([text])[0] == truth(text)


def test_every_character_and_special_string():
    """Alone, inside and beside words: all characters up to Latin Extended-B and beyond, and the strings of special tokens."""
    texts = []
    for c in [*map(chr, range(1, 0x300)), *"ΣσςЖ中\u2003\ufb01\U0001f600"]:
        texts += [c, f"a{c}b", f"{c}{c}x {c}", f"1{c} '{c}s"]
    for special in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|other|>", "<|", "|>"):
        texts += [special, f"a {special} b", f"x{special}{special}y"]
    got = encoder().encode(texts)
    assert [t for t, ids in zip(texts, got) if ids != truth(t)] == []
    assert np.frombuffer(encoder().encode(["a <|endoftext|>"])[0], "<u4")[-1] == 49407


def test_cache_limit_changes_nothing():
    small = WordEncoder(limit=3)
    texts = ["one two three four", "two three five", None, "", LONG[:2000]]
    assert small.encode(texts) == [truth(t) for t in texts]
    assert small.encode(texts) == [truth(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=300), st.integers(1, 60000))
def test_blocks_round_trip(ids, scale):
    x = np.array([i * scale % 500_000 for i in ids], dtype=np.int64)
    assert (decode_block(encode_block(x)) == x).all()


def test_repetitive_ids_shrink_and_damage_is_found():
    x = np.tile(np.arange(40), 5000)
    block = encode_block(x)
    assert len(block) < len(x) and (decode_block(block) == x).all()
    for at in (0, 9, 30, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 4
        with pytest.raises(CorruptBlock):
            decode_block(bytes(bad))
    with pytest.raises(CorruptBlock):
        decode_block(block[:-2])


def test_segments():
    docs = [b"", truth("a b c"), truth(LONG[:5000])]
    assert unpack_segment(pack_segment([None, -5, 2**60], docs)) == ([None, -5, 2**60], docs)
    with pytest.raises(CorruptBlock):
        unpack_segment(pack_segment([1], [truth("some text")])[:-1])


def files(spark, docs, **options):
    path = shared_dir(spark, "test-tokens")
    write_token_files(docs, path, **options)
    return with_starts(read_token_files(spark, path), segment_starts(spark, path)).orderBy("start").collect()


def test_token_files(spark, odd, empty):
    for size in (1 << 21, 50):
        found = files(spark, odd, segment_tokens=size)
        want = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0]))
        assert [r.doc_id for r in found] == [i for i, _ in want]
        assert sorted((str(r.doc_id), bytes(r.ids)) for r in found) == sorted((str(i), truth(t, [1])) for i, t in want)
        at = 0
        for r in found:
            assert r.start == at and r.n_tokens == len(r.ids) // 4
            at += r.n_tokens
    assert files(spark, empty) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.sampled_from([4, 8, 16]))
def test_packing_is_exact(lengths, capacity):
    pieces = pack_block(np.array(lengths, dtype=np.int64), capacity)
    room = room_for(sum(lengths), capacity)
    assert room.sum() == sum(lengths) and all(n == capacity or n & (n - 1) == 0 for n in room)
    for nth, column, size in ((0, 1, lengths), (3, 4, room)):
        for key, n in enumerate(size):
            mine = sorted((p[column], p[2]) for p in pieces.tolist() if p[nth] == key)
            assert [a for a, _ in mine] == [sum(b for _, b in mine[:i]) for i in range(len(mine))] and sum(b for _, b in mine) == n


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    lengths = rng.integers(50, 2000, 400)
    pieces = pack_block(lengths, 4096)
    cost = np.bincount(pieces[:, 3], weights=attention_cost(pieces[:, 2]))[: int(lengths.sum()) // 4096]
    cut = np.bincount(pieces[:, 0]) > 1
    assert cost.max() < 1.6 * cost.min() and cut.mean() < 0.25


def test_pack_query(odd, empty):
    found = pack(odd, block_tokens=5000)
    rows = found.collect()
    docs = sorted((r.doc_id is None, r.doc_id or 0, len(truth(r.text, [2])) // 4) for r in odd.collect())
    assert sum(r.length for r in rows) == sum(n for *_, n in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == docs
    texts = {(r.doc_id, len(truth(r.text, [2])) // 4): truth(r.text, [2]) for r in odd.collect()}
    assert all(bytes(r.ids) == texts[r.doc_id, r.doc_tokens][4 * r.start : 4 * (r.start + r.length)] for r in rows)
    whole = sequences(found).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(n for *_, n in docs) and all(len(r.ids) == 4 * r.tokens for r in whole)
    assert pack(empty).count() == 0
    assert zlib.crc32(b"") == 0
