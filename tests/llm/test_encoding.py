from __future__ import annotations

import base64
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.prefix_bpe import EditableEncoding, PieceTable, PrefixBpe, codec, decode_documents, encode_documents
from millrace.llm.token_shards import PerfectHash, key_hashes, mix, read_tokens, write_tokens

RANKS = P.path("byte_bpe_50k.tiktoken")
VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=codec(RANKS, P.PATTERN).ranks, special_tokens={})


def test_ids_and_round_trip(docs, rows, plain):
    e = encode_documents(docs, RANKS, P.PATTERN, decoded=True)
    got = {r.doc_id: r for r in e.collect()}
    for i, t in rows:
        assert np.frombuffer(got[i].ids, "<u4").tolist() == plain.encode_ordinary(t or "")
        assert got[i].decoded == (t or "").encode()
    back = decode_documents(e.drop("decoded"), RANKS, P.PATTERN)
    assert {r.doc_id: r.decoded for r in back.collect()} == {i: (t or "").encode() for i, t in rows}


def test_odd_and_empty_tables(odd, empty):
    assert encode_documents(odd, RANKS, P.PATTERN).count() == 6 and encode_documents(empty, RANKS, P.PATTERN).count() == 0
    assert encode_documents(odd, RANKS, P.PATTERN).where("doc_id is null and length(ids) = 0").count() == 1


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" ab'stredv\n\t.,1é日  Z"), max_size=60))
def test_any_text_encodes_as_the_library_does(text):
    import tiktoken

    c = codec(RANKS, P.PATTERN)
    t = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert np.frombuffer(c.encode_texts([text])[0], "<u4").tolist() == t.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(" abthe'sre\n.1"), max_size=40), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 4), st.text(st.sampled_from(" at'e\ns"), max_size=4)), max_size=8))
def test_edits_and_appends_are_exact(text, edits):
    import tiktoken

    c = codec(RANKS, P.PATTERN)
    t = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    e = EditableEncoding(c, text)
    for at, cut, new in edits:
        a = min(at, len(text))
        b = min(len(text), a + cut)
        text = text[:a] + new + text[b:]
        e.replace(a, b, new)
        assert e.text == text and e.ids == t.encode_ordinary(text)
    e.append(" more's")
    assert e.ids == t.encode_ordinary(text + " more's")


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40))
def test_every_prefix_of_a_piece(data):
    c: PrefixBpe = codec(RANKS, P.PATTERN)
    table = PieceTable(c)
    for i in range(len(data)):
        table.append(data[i : i + 1])
    for n in range(len(data) + 1):
        assert table.ids(n) == c.merged(data[:n])


def test_edits_encode_near_the_edit_only():
    c = codec(RANKS, P.PATTERN)
    e = EditableEncoding(c, "word " * 2000)
    assert e.replace(5000, 5001, "x") < 40


def _library(rows, plain=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    if plain:
        t.encode_special_tokens = True
    return [np.array(e.ids + [2], "<u4") for e in t.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def test_shards_hold_the_library_ids_in_order(spark, docs, rows):
    manifest = write_tokens(docs, VOCABULARY, end_id=2, vocabulary=50257)
    got = {r.doc_id: r for r in read_tokens(spark, manifest, docs.select("doc_id")).withColumn("crc", F.crc32("ids")).collect()}
    start = 0
    for (i, _), ids in zip(rows, _library(rows), strict=True):
        assert got[i].start == start and bytes(got[i].ids) == ids.tobytes() and got[i].crc == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert sum(m["tokens"] for m in manifest) == start and sum(m["docs"] for m in manifest) == len(rows)


SPECIAL = [(0, "end <|endoftext|> of"), (1, "<|endoftext|>"), (2, "a<|endoftext|>b<|endoftext|>"), (3, "<|endoftext| >"), (4, "<|startoftext|> <|im_start|>"), (5, "x" * 300 + "<|endoftext|>\n\n"), (6, None)]


@pytest.mark.parametrize("plain", [False, True])
def test_strings_of_special_tokens_as_the_library_takes_them(spark, plain):
    df = spark.createDataFrame(SPECIAL, "doc_id long, text string")
    manifest = write_tokens(df, VOCABULARY, end_id=2, vocabulary=50257, plain_specials=plain)
    got = {r.doc_id: bytes(r.ids) for r in read_tokens(spark, manifest, df.select("doc_id")).collect()}
    want = {i: ids.tobytes() for (i, _), ids in zip(SPECIAL, _library(SPECIAL, plain), strict=True)}
    assert got == want and (50256 in np.frombuffer(got[0], "<u4")) is not plain


def test_strings_of_special_tokens_are_ordinary_for_ranks(spark):
    import tiktoken

    from millrace.llm.prefix_bpe import encode_documents

    df = spark.createDataFrame(SPECIAL, "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encode_documents(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    assert got == {i: plain.encode_ordinary(t or "") for i, t in SPECIAL}


def test_absent_and_repeated_keys(spark, odd, empty):
    manifest = write_tokens(odd, VOCABULARY, end_id=2, vocabulary=50257)
    got = read_tokens(spark, manifest, odd.select("doc_id").unionAll(spark.sql("select 999L"))).collect()
    assert sum(r.ids is None for r in got) == 1 and next(r for r in got if r.ids is None).doc_id == 999
    assert len({(r.start) for r in got if r.ids is not None}) == 6
    assert write_tokens(empty, VOCABULARY, 2, 50257) == []
    assert read_tokens(spark, [], odd.select("doc_id")).where("ids is null").count() == 6


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 50_000):
        h = key_hashes(np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64))
        assert sorted(PerfectHash.build(h).slots(h)) == list(range(n))
    same = np.full(3, 12345, np.uint64)
    assert len(PerfectHash.build(same).left) == 3 and mix(np.zeros(1)).shape == (1,)
