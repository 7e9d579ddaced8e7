from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import linededup, setjoin, substring
from millrace.llm.components import components
from millrace.llm.fmindex import contamination
from millrace.llm.substring import FingerprintIndex
from tests.llm.conftest import invented


@pytest.mark.parametrize("width,gram", [(35, 8), (5, 2), (3, 3)])
def test_repeated_runs_of_words(docs, rows, width, gram):
    out = substring.drop_repeats(docs, width, gram).withColumn("sha", F.sha2("kept", 256))
    got = {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in out.collect()}
    want = substring.brute_force([t for _, t in rows], width)
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)} and sum(w[1] for w in want) > 100


def test_repeated_runs_on_odd_and_empty_tables(odd, empty):
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring.drop_repeats(odd, 3, 2).collect())
    assert got == [(0, 0, 0), (0, 2, 0), (5, 2, 0), (5, 3, 3), (5, 3, 3), (7, 0, 0)]
    assert substring.drop_repeats(empty).count() == 0


def test_index_names_what_occurs_twice(spark):
    index = FingerprintIndex(spark, buckets=3)
    put = lambda *x: {r.fp for r in index.ingest(spark.createDataFrame([(f, d, 0, 1, 1, 0, 1) for f, d in x], substring._ENTRY)).collect()}
    assert put((1, 1), (2, 1), (3, 1), (3, 1)) == {3}
    assert put((1, 9), (3, 1), (4, 1)) == {1, 3}
    assert put((1, 1), (2, 1), (5, 1), (5, 2)) == {1, 2, 5}
    index.compact()
    assert len(index.runs) == 1
    again = FingerprintIndex(spark, folder=index.folder)
    assert again.runs == index.runs and again.state["buckets"] == 3
    rows = again.run(again.runs[0])
    assert sorted((r.fp, r.d1, r.many) for r in rows.collect()) == [(1, 1, True), (1, 9, False), (2, 1, True), (3, 1, True), (4, 1, False), (5, 1, False), (5, 2, False)]
    assert "SortMergeJoin" in (plan := rows.join(rows.select("fp").hint("merge"), "fp", "left_semi")._jdf.queryExecution().executedPlan().toString()) and "Exchange" not in plan
    assert put((4, 7), (5, 1), (6, 1)) == {4, 5} and put((6, 1), (1, 1)) == {1, 6}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_batches_are_judged_with_all_that_came_before(spark, rows, order):
    """Each batch by brute force over the history and itself; compaction and a reopened index change nothing."""
    parts = [rows[0::3], rows[1::3], rows[2::3] + rows[3:6]]
    index, history = FingerprintIndex(spark, buckets=4, most_runs=2), []
    for step, k in enumerate(order):
        df = spark.createDataFrame(parts[k], "doc_id long, text string").repartition(2)
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.sha) for r in substring.drop_repeats(df, 5, 2, batches=1 + step % 2, index=index).withColumn("sha", F.sha2("kept", 256)).collect())
        history += parts[k]
        want = substring.brute_force([t for _, t in history], 5)[len(history) - len(parts[k]) :]
        assert got == sorted((i, *w) for (i, _), w in zip(parts[k], want, strict=True))
        assert step == 0 or sum(w[1] for w in want) > 50
        if step == 1:
            index.compact()
            index = FingerprintIndex(spark, folder=index.folder, most_runs=2)
    assert len(index.runs) <= 2


def test_a_later_batch_repeats_parts_of_an_older_one(spark):
    p, q = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    index = FingerprintIndex(spark, buckets=2)
    first = spark.createDataFrame([(1, p), (2, q), (3, q)], "doc_id long, text string")
    assert [r.n_removed for r in substring.drop_repeats(first, index=index).orderBy("doc_id").collect()] == [0, 60, 60]
    second = spark.createDataFrame([(4, "x " + p), (5, "y " + q), (6, "z"), (7, p[: len(p) // 2])], "doc_id long, text string")
    assert [r.n_removed for r in substring.drop_repeats(second, index=index).orderBy("doc_id").collect()] == [60, 60, 0, 0]


def test_repeated_lines(docs, rows, odd, empty):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linededup.drop_repeated_lines(docs).collect()}
    want = linededup.brute_force(rows)
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)} and sum(w[1] for w in want) > 10
    assert linededup.drop_repeated_lines(odd, keep=["doc_id", "text"]).count() == 6 and linededup.drop_repeated_lines(empty).count() == 0


def test_lines_by_sql(spark, docs):
    import duckdb

    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
    want = duckdb.sql(linededup.duckdb_sql()).df().sort_values("doc_id")
    got = linededup.drop_repeated_lines(docs).toPandas().sort_values("doc_id")
    assert (got[["doc_id", "n_lines", "n_removed", "text"]].to_numpy() == want[["doc_id", "n_lines", "n_removed", "text"]].to_numpy()).all()


def test_lines_keep_other_columns(docs):
    out = linededup.drop_repeated_lines(docs, keep=["lang", "n"])
    assert out.columns == ["doc_id", "lang", "n", "n_lines", "n_removed", "text"] and out.where("lang = 'en' and n = 1").count() == out.count()


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (2, 50)])
@pytest.mark.parametrize("seed", [7, 8])
def test_similar_groups(spark, k, percent, seed):
    rows = invented(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.similar_groups(df, k, percent).collect()}
    assert got == setjoin.brute_force(rows, k, percent)


def thue_morse() -> tuple[str, str]:
    """Two words of 2,048 letters that any polynomial hash modulo 2**64 takes for one."""
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - x for x in bits]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_words_that_collide_by_their_form_stay_apart(spark):
    a, b = thue_morse()
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{a} x y z u"), (4, f"{b} x y z u"), (5, a[:64]), (6, b[:64])], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in setjoin.similar_groups(df).collect()} == {i: i for i in range(1, 7)}
    item = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in contamination(df, item).collect()} == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0}


def test_long_lists_of_sets_that_do_not_link(spark):
    """A list of 1,500 sets that share hot shingles, three quarters alike, among which a few link."""
    hot = " ".join(f"h{i}" for i in range(9))  # six four-word shingles
    rows = [(i, f"{hot} u{i}") for i in range(1500)] + [(2000 + i, f"{hot} v{i} w{i} x{i}") for i in range(50)]
    rows += [(3000 + i, f"{hot} {' '.join(f'y{j}' for j in range(30))} z{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in setjoin.similar_groups(df, 4, 85).collect()}
    assert got == {i: 3000 if i >= 3000 else i for i, _ in rows}
    lists = setjoin.shared_lists(setjoin.prefixes(df, 4, 85, np.full(1 << 16, 9000, np.uint16), "text"))
    assert lists.groupBy("t", "c").count().where("count > 1").isEmpty() and lists.groupBy("t").count().where("count >= 1500").count() > 0


def test_similar_groups_on_odd_and_empty_tables(odd, empty):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in setjoin.similar_groups(odd).collect())
    assert got == [(0, 0, 0), (0, 1, 0), (5, 1, 5), (5, 1, 5), (5, 1, 5), (7, 0, 7)]
    assert setjoin.similar_groups(empty).count() == 0


def test_lists_are_the_same_whatever_the_batches(spark):
    rows = [(t, hashlib.md5(bytes([c])).digest(), 5, 0, 0) for t, cs in enumerate([[1], [1, 1], [1, 2], [3, 3, 4, 5], [6]]) for c in cs]
    rows += [(9, hashlib.md5(bytes([c])).digest(), 5, 0, c) for c in (1, 1, 2)]
    index = spark.createDataFrame(rows, "t long, c binary, n int, p int, part short")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "2", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = setjoin.shared_lists(index).collect()
            assert sorted(r.t for r in got) == [2, 2, 3, 3, 3, 9, 9]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)] + [(int(a), int(b)) for a, b in rng.integers(400, 500, (60, 2))]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_call_that_fails_anywhere_leaves_no_trace(spark, monkeypatch):
    """The second of two batches fails once at each step in turn; repeated, it gives what brute force gives."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    first = [(k, words(k, 80)) for k in range(4)]
    second = [(10 + k, words(20 + k, 60)) for k in range(3)] + [(14, words(30, 10) + " " + words(1, 40)), (15, words(30, 50)), (16, words(30, 50))]
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    rows_of = lambda out: sorted((r.doc_id, r.n_words, r.n_removed, r.sha) for r in out.withColumn("sha", F.sha2("kept", 256)).collect())
    want = sorted((i, *w) for (i, _), w in zip(second, substring.brute_force([t for _, t in first + second], 35)[len(first) :], strict=True))
    assert 0 < sum(w[2] for w in want) < sum(w[1] for w in want)
    steps = ["stage", "remember", "_note", "compact"]
    for step in steps:
        index = FingerprintIndex(spark, buckets=2, most_runs=2)
        substring.drop_repeats(df(first), index=index, call="first")
        listed = dict(index.state)
        real = getattr(FingerprintIndex, step)

        def failing(self, *a, real=real, **b):
            real(self, *a, **b) if step not in ("_note", "compact") else None
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(FingerprintIndex, step, failing)
            with pytest.raises(OSError, match="lost"):
                substring.drop_repeats(df(second), index=index, call="second")
        again = FingerprintIndex(spark, folder=index.folder, most_runs=2)
        assert step == "compact" or again.state == listed
        for _ in range(2):  # and once more after it went well
            assert rows_of(substring.drop_repeats(df(second), index=again, call="second")) == want, step
        assert rows_of(substring.drop_repeats(df(second), index=again, call="third")) == sorted((i, n, n if n >= 35 else 0, hashlib.sha256(b"").hexdigest()) for i, n, *_ in want)
        index.drop()


def test_own_batches_pass_a_compaction(spark, docs, rows, monkeypatch):
    merged, joined = [], []
    real, stage = FingerprintIndex.merged, FingerprintIndex.stage
    monkeypatch.setattr(FingerprintIndex, "merged", lambda self, runs: merged.append(real(self, runs)) or merged[-1])
    monkeypatch.setattr(FingerprintIndex, "stage", lambda self, e, earlier: joined.append(list(earlier)) or stage(self, e, earlier))
    got = {r.doc_id: r.n_removed for r in substring.drop_repeats(docs, 5, 2, batches=4).collect()}
    assert got == {i: w[1] for (i, _), w in zip(rows, substring.brute_force([t for _, t in rows], 5), strict=True)}
    assert len(merged) == 2 and merged[0] in joined[2] and merged[1] in joined[3]


def test_keys_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError):
        substring.drop_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


@pytest.mark.parametrize("percent,k", [(1, 1), (33, 1), (50, 1), (20, 3), (51, 1), (67, 3), (75, 1), (100, 1)])
def test_similarity_joins_at_every_threshold(spark, percent, k):
    import random

    r = random.Random(percent * 7 + k)
    sets = [" ".join(r.sample("abcdefgh", r.randint(1, 6))) for _ in range(70)] + [" ".join(f"{c}{i}" for i in range(12)) for c in "pq"] + [" ".join(f"p{i}" for i in range(r.randint(6, 11))) for _ in range(6)]
    rows = list(enumerate(sets))
    got = {r_.doc_id: (r_.n_shingles, r_.component_id) for r_ in setjoin.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=k, percent=percent).collect()}
    assert got == setjoin.brute_force(rows, k, percent)


def test_thresholds_that_mean_nothing_are_refused(docs):
    for percent in (0, 101):
        with pytest.raises(ValueError, match="between 1 and 100"):
            setjoin.similar_groups(docs, k=1, percent=percent)
