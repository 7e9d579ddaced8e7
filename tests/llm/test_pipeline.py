from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from millrace.llm import fmindex, linededup, setjoin


@pytest.fixture(scope="module")
def tables(spark, docs, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{at}/documents.parquet")
    items = [(i, " ".join((t or "").split()[3:20])) for i, t in rows if t and i % 9 == 0]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, items


def plainly(rows, items):
    import tiktoken

    from millrace.llm.prefix_bpe import codec

    left = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    lines = linededup.brute_force(left)
    left = [(i, text) for (i, _), (n, gone, text) in zip(left, lines, strict=True) if not (gone and gone == n)]
    groups = setjoin.brute_force(left, 5, 80)
    left = [(i, t) for i, t in left if groups[i][0] == 0 or groups[i][1] == i]
    hits = fmindex.brute_force(left, items)
    left = [(i, t) for i, t in left if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])]
    enc = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks, special_tokens={})
    out = {}
    for i, t in left:
        ids = np.array(enc.encode_ordinary(t), "<u4")
        out[i] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    return out


def test_run_equals_the_plain_version(spark, tables, rows):
    at, items = tables
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, at).collect()}
    want = plainly(rows, items)
    assert got == want and 5 < len(want) < len(rows) - 10


def test_stages_keep_the_columns_of_documents(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name


def test_stages_take_empty_and_odd_tables(spark, tables, odd):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    strange = odd.selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "cast(null as long) n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tables[0]).count() == 0
        stage(spark, strange, tables[0]).count()
    assert corpus_pipeline.near_duplicates(spark, strange, tables[0]).count() == 5


def test_wrong_languages_go_whatever_their_label(spark, tables):
    rng = np.random.default_rng(5)
    words = {"en": "the thing and other with that which were there".split(), "de": "der die und schön über auch nicht sich straße".split()}
    rows = [(i, " ".join(rng.choice(words[k], 12)), k) for i in range(120) for k in [["en", "de"][i % 2]]]
    rows += [(200, " ".join(words["de"]), "en"), (201, " ".join(words["en"]), "de"), (202, "123 -- 4", "en"), (203, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("doc_id", "text", "lang", "'s' source", "cast(length(text) as long) n_chars")
    english = {r.doc_id for r in corpus_pipeline.language_id(spark, df, tables[0], languages=("en",)).collect()}
    assert english == {*range(0, 120, 2), 201}
    every = {r.doc_id for r in corpus_pipeline.language_id(spark, df, tables[0]).collect()}
    assert every == {*range(120), 200, 201}


def test_rows_that_share_an_id_are_judged_apart(spark, tables):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text + " more"), (2, "another text of its own here"), (3, text), (3, text), (None, text), (None, "nobody has this one in full")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars")
    got = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, df, tables[0]).collect())
    assert got == [(0, "nobody has this one in full"), (1, text), (2, "another text of its own here")]
