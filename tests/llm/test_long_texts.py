"""Texts of millions of characters through every operator and stage, next to short ones."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from millrace.llm import fmindex, langid, linededup, ordinal, setjoin, substring, syncmers
from millrace.llm.prefix_bpe import codec, encode_documents
from millrace.llm.token_shards import read_tokens, write_tokens


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(3000)] + ["the", "and,", "für", "end."])
    long = " ".join(words[rng.integers(0, len(words), 900_000)])  # about five million characters
    lines = "\n".join(" ".join(words[rng.integers(0, len(words), 8)]) for _ in range(60_000))
    part = " ".join(long.split(" ")[1000:1100])
    return [(1, long), (2, "short text"), (3, lines), (4, "x" * 300_000), (5, long + " and more"), (6, f"own words {part} to the end"), (7, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).persist()


def test_ids(spark, docs, rows):
    import tiktoken
    from tokenizers import Tokenizer

    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks, special_tokens={})
    got = {r.doc_id: r for r in encode_documents(docs.where("doc_id <> 4"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, decoded=True).collect()}
    for i, t in rows:
        if i != 4:
            assert np.array_equal(np.frombuffer(got[i].ids, "<u4"), plain.encode_ordinary(t or "")) and got[i].decoded == (t or "").encode()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    manifest = write_tokens(docs, P.path("byte_bpe_50k.json"), end_id=2, vocabulary=50257)
    shards = {r.doc_id: bytes(r.ids) for r in read_tokens(spark, manifest, docs.select("doc_id")).collect()}
    for i, t in rows:
        assert shards[i] == np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


def test_repeats(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in substring.drop_repeats(docs).collect()}
    assert got == {i: w for (i, _), w in zip(rows, substring.brute_force([t for _, t in rows]), strict=True)}
    lines = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linededup.drop_repeated_lines(docs).collect()}
    assert lines == {i: w for (i, _), w in zip(rows, linededup.brute_force(rows), strict=True)}


def test_groups_and_hits(spark, docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.similar_groups(docs).collect()}
    assert got == setjoin.brute_force(rows) and got[5][1] == 1
    items = [(1, " ".join(rows[0][1].split(" ")[500_000:500_030])), (2, "short")]
    found = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in fmindex.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == fmindex.brute_force(rows, items)


def test_models_and_fingerprints(spark, docs, rows):
    model = langid.fit(docs, P.path("piece_bpe_32k.model"), docs["doc_id"] > 0)
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()} == {i: "en" if t else "und" for i, t in rows}
    grades = ordinal.fit(docs, spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, grade int"))
    assert ordinal.grade_documents(docs, grades, tail=2).count() == len(rows)
    got = {r.doc_id: r for r in syncmers.fingerprint_pairs(docs).collect()}
    for i, t in rows:
        assert got[i].fingerprint == syncmers.as_text(syncmers.fingerprints([(t or "").encode()])[0]) and got[i].n_chars == len(t or "")


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, "short text of a benchmark item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.where("doc_id <> 4").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 2, 3, 6}
