import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, docs, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orbita.llm import bpe, packing, token_store
from orbita.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = bpe.Encoder(PATH)
LIBRARY = Tokenizer.from_file(PATH)  # as it comes
PIECES = ["don't", "'s", "a.", "é,", "12", "!!", "<|endoftext|>", "日本", "x'", "...", "n't.", "I'll!", "_a", "ﬁ", "a1.", "́b",
          "\U0001F642", " ", "  ", "\n", "\n\n", "\t", " ", "　", "\r\n", "\x1c", "×.", "÷,", "’,", "Å!", " "]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.sampled_from(PIECES), max_size=12), st.text(max_size=20).filter(lambda s: s.isprintable()))
@settings(max_examples=400, deadline=None)
def test_units_give_the_ids_of_the_whole_text(parts, tail):
    text = "".join(parts) + tail
    assert ENCODER.encode_all([text])[0].tolist() == ids_of(text)[:-1]


def test_added_tokens_are_the_libraries_own(spark):
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|>\n\n<|endoftext|>'s", ""]
    assert [x.tolist() for x in ENCODER.encode_all(texts)] == [ids_of(t)[:-1] for t in texts]
    assert ids_of("a<|endoftext|>")[1] == 50256
    path = scratch_path(spark, "store-added")
    token_store.write_store(docs(spark, list(enumerate(texts))), path, PATH, 2)
    got = token_store.read_store(spark, path, with_ids=True).orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [ids_of(t) for t in texts]


def test_dictionary_rows_come_from_all_of_the_table(spark):
    rows = [(i, f"text of document {i} " * 20) for i in range(400)] + [(1000 + i, "one hot text " * 30) for i in range(800)]
    df = docs(spark, rows)
    a, b = (sorted(token_store.dictionary_rows(d, 50)) for d in (df, df.repartition(7)))
    assert a == b and len(a) == 50 and 5 < sum("document" in t for t in a) < 40
    assert token_store.dictionary_rows(docs(spark, [(1, "x" * 9000), (2, None), (3, "short")]), 50) == ["short"]


def test_cache_starts_afresh_without_changing_ids():
    small = bpe.Encoder(PATH, cache_entries=3)
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join(rng.choice(PIECES) for _ in range(9)) for _ in range(5)]
        assert [x.tolist() for x in small.encode_all(texts)] == [ids_of(t)[:-1] for t in texts]


def expected(rows):
    return sorted(((i, tuple(ids_of(t))) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))


def test_store_round_trip_and_edges(spark):
    path = scratch_path(spark, "store-test")
    rows = edge_rows()
    token_store.write_store(clashing(docs(spark, rows), "part", "seg", "payload"), path, PATH, 3)
    got = token_store.read_store(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [i for i, _ in expected(rows)]
    assert sorted((r.doc_id or 0, tuple(r.ids)) for r in got) == sorted((i or 0, x) for i, x in expected(rows))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert token_store.read_document(spark, path, 6) == [ids_of("one")]
    assert token_store.read_document(spark, path, 1) == [ids_of(rows[0][1])] * 2
    assert token_store.read_document(spark, path, 99) == []


def test_store_of_an_empty_table(spark):
    path = scratch_path(spark, "store-test")
    token_store.write_store(docs(spark, []), path, PATH, 2)
    assert token_store.read_store(spark, path).collect() == []


def test_store_rejects_another_dictionary(spark):
    path = scratch_path(spark, "store-test")
    token_store.write_store(docs(spark, edge_rows()), path, PATH, 2)
    frames = token_store._Frames("0" * 64, b"", 2)
    segment = token_store._segments(spark, path).first().asDict()
    with pytest.raises(ValueError):
        frames.ids(segment, 0)


def test_level_makes_the_sum_of_squares_least():
    rng = np.random.default_rng(2)
    p = packing.SumOfSquares(12)
    for _ in range(300):
        p.counts[:] = 0
        p.counts[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 13))
        best = None
        for level in range(0, 13 - size):
            if level and not p.counts[level]:
                continue
            n = p.counts.copy()
            n[level] -= level > 0
            if level + size < 12:
                n[level + size] += 1
            value = int((n[1:12] ** 2).sum())
            best = value if best is None else min(best, value)
        chosen = p.level(size)
        n = p.counts.copy()
        assert chosen == 0 or n[chosen] > 0
        n[chosen] -= chosen > 0
        if chosen + size < 12:
            n[chosen + size] += 1
        assert int((n[1:12] ** 2).sum()) == best


def check_pieces(rows, pieces, window=packing.WINDOW):
    ids = sorted((i or 0, tuple(x)) for i, x in expected(rows))
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append(p)
    assert sorted(seqs) == list(range(len(seqs)))
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
    total = sum(len(x) for _, x in ids)
    assert sum(p.length for p in pieces) == total
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id or 0, []).append(p)
    for doc, own in by.items():
        texts = [x for i, x in ids if i == doc]
        for p in own:
            assert any(p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(
                np.array(x[p.start:p.start + p.length], "<u4").tobytes()) for x in texts)
    return len(seqs), total


def test_packing_edges(spark):
    rows = edge_rows()
    df = clashing(docs(spark, rows).repartition(2), "start", "sequence_id", "part")
    sequences, total = check_pieces(rows, packing.pack(df, PATH).collect())
    assert sequences <= -(-total // packing.WINDOW) + 2  # one open window per partition at most
    assert packing.pack(docs(spark, []), PATH).collect() == []


def test_packing_is_tight(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "word"]) for _ in range(rng.randrange(1, 900)))) for i in range(120)]
    sequences, total = check_pieces(rows, packing.pack(docs(spark, rows).coalesce(1), PATH).collect())
    assert sequences == -(-total // packing.WINDOW)
