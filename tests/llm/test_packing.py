import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tendril.llm import packing as P

ODD = ["", "  a\n\n b \t c", "   x  <|endoftext|> y's it'll 123 ４５ é́ 👩‍👩‍👧 ñ\r\n\r\n  ", "\x00\x1f ​ z\x85", "a" * 3000 + " b" * 1000, "  \n \n\n\t  ", "I'M they'RE don't", "x  y   z"]


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(P.default_tokenizer())
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers_library(exact, monkeypatch):
    encoder = P.Encoder(P.default_tokenizer())
    assert encoder.fast is not None

    @settings(max_examples=200, deadline=None)
    @given(st.text(max_size=60))
    def check(text):
        assert encoder.ids(text).tolist() == [*exact(text), 0]

    check()
    for size in (P.PIECE, 40):
        monkeypatch.setattr(P, "PIECE", size)
        for text in ODD:
            assert encoder.ids(text).tolist() == [*exact(text), 0]


@pytest.mark.parametrize("run", [" ", "\t", "\n", " \n\t", "\u3000 "])
def test_ids_of_long_white_space(exact, run):
    encoder = P.Encoder(P.default_tokenizer())
    for text in (f"word{run * (2_000_000 // len(run))}word", run * (1_500_000 // len(run)), f"a{run * 24_000}b{run * 26_000} c"):
        assert encoder.ids(text).tolist() == [*exact(text), 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 512), min_size=1, max_size=120))
def test_windows_hold_all_parts(sizes):
    of = P.deal(np.array(sizes))
    loads = np.bincount(of, sizes)
    assert loads.max() <= P.CAPACITY and loads.min() > 0 or sum(sizes) == 0


def test_differencing_is_balanced():
    sizes = np.random.default_rng(0).integers(1, 513, 1000)
    loads = np.bincount(P.difference(sizes, 260), sizes, 260)
    assert loads.max() - loads.min() < 40


def check_pieces(rows, docs, exact):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    for doc, text in docs.items():
        ids = np.array([*exact(text or ""), 0], "<u4")
        at = 0
        for r in sorted(by_doc[(doc, len(ids))], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_given_documents(spark, exact):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = P.op1_packing(spark, "/root/testdata/sf0.01").collect()
    check_pieces(rows, docs, exact)
    tokens, windows = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert 1 - tokens / (P.CAPACITY * windows) < 0.01


def test_odd_documents(spark, odd_docs, no_docs, exact):
    rows = P.pack(odd_docs, P.default_tokenizer()).collect()
    assert sum(r.length for r in rows) == sum(len(exact(r.text or "")) + 1 for r in odd_docs.collect())
    check_pieces(rows, {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id != 5}, exact)
    assert all(len(r.ids) == r.length for r in rows) and sum(r.doc_id == 5 for r in rows) == 2
    assert P.pack(no_docs, P.default_tokenizer()).count() == 0
