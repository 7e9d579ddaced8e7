"""The source audit, fingerprint groups and the target sample, each against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm import divergence as dv
from millrace.llm import importance as im
from millrace.llm import simhash as sh

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Source divergence


def plain_divergence(rows, least=3, ranks=200):
    counts, texts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = [t.translate(AZ) for t in found]
        counts[lang, source].update(found)
        texts[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in texts[lang].items() if n >= least]
        v, mine = len(kept), [s for k, s in groups if k == lang]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in mine}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (total[s] + v) for t in kept} for s in mine}
        whole = sum(total.values())
        q = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in mine) + 1) // (whole + v) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        pairs = [(sum(f(p[source][t], p[o][t]) for t in kept), o) for o in mine if o != source]
        terms = [(f(p[source][t], q[t]), t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.append((lang, source, part, item, value, k))
    return sorted(out)


def divergences(df, **kw):
    return sorted(tuple(r) for r in dv.divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def spoken(rows):
    return [(t, ["en", "de", None, "xx"][i % 4 if i % 7 else 0], [None, "a", "b", "c/d", "é"][i % 5]) for i, t in rows]


@pytest.mark.parametrize("ranks,least", [(200, 3), (2, 1)])
def test_divergence_equals_the_plain_version(spark, rows, ranks, least):
    r = spoken(rows) + [("", "zz", "only"), (None, "zz", "other"), ("thrice Thrice", "zz", "only"), (None, "yy", None)]
    df = spark.createDataFrame([(*x, "t", 1) for x in r], "text string, lang string, source string, term string, n int").repartition(3)
    assert divergences(df, most_ranks=ranks, least_texts=least) == plain_divergence(r, least, ranks)


def test_divergence_sql_says_the_same(spark, rows):
    import pyarrow as pa

    r = spoken(rows)
    documents = pa.table({"text": pa.array([x[0] for x in r]), "lang": pa.array([x[1] for x in r]), "source": pa.array([x[2] for x in r])})
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(con.execute(dv.duckdb_sql()).fetchall()) == plain_divergence(r)


def test_divergence_of_few_held_terms_and_nothing(spark, docs, empty, rows):
    assert dv.divergence(empty).count() == 0
    some = dv.term_counts(docs, most_held=5).groupBy("term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).collect()
    want, texts = Counter(), Counter()
    for _, t in rows:
        found = [x.translate(AZ) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
        want.update(found)
        texts.update(set(found))
    assert {r.term: (r.n, r.texts) for r in some} == {t: (n, texts[t]) for t, n in want.items()}


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, v = 10**15, 3 * 10**15 + 7, 12345
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    assert df.select(dv.share(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (n + 1) // (total + v)


# SimHash


def plain_simhash(text, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(AZ).encode())
    runs = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    ones = Counter(b for r in runs for b in range(64) if xxh64_intdigest(r, 42) >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(runs))


def plain_components(prints, most=3):
    """{fingerprint: set of fingerprints that links reach} by comparing all pairs."""
    u = sorted(set(prints))
    root = {f: f for f in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(u):
        for b in u[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in u}


def test_groups_equal_the_plain_version(docs, rows):
    prints = {i: plain_simhash(t) for i, t in rows}
    root = plain_components(prints.values())
    least = {}
    for i, f in sorted(prints.items()):
        least.setdefault(root[f], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.near_groups(docs).collect()}
    assert got == {i: (f"{f:016x}", least[root[f]]) for i, f in prints.items()}
    assert len(set(least.values())) < len(set(prints.values()))  # some different fingerprints are linked


def test_long_texts_are_summed_in_steps():
    import pyarrow as pa

    texts = ["a b c d e f g h", None, " ".join(str(i % 977) for i in range(5000)), "", "x"]
    assert sh.simhashes(pa.array(texts), at_once=700).tolist() == [plain_simhash(t) for t in texts]
    assert sh.simhashes(pa.array([], pa.string())).tolist() == []


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_every_link_is_found_at_an_anchor(spark):
    """Pairs at each distance around random points, on either side of the halves, and beyond the limit."""
    r = np.random.default_rng(5)
    prints = []
    for _ in range(60):
        base = int(r.integers(0, 1 << 63)) * 2 + int(r.integers(0, 2))
        prints.append(base)
        for d in (1, 2, 3, 4):
            x = base
            for b in r.choice(64, d, replace=False):
                x ^= 1 << int(b)
            prints.append(x)
    prints += [0, 1, 1 << 63, (1 << 64) - 1, (1 << 31), (1 << 32)]
    df = spark.createDataFrame([(signed(x),) for x in set(prints)], "fp long").repartition(3)
    for most in (0, 1, 3):
        found = {(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in sh.links(df, most).df.collect()}
        assert all((a ^ b).bit_count() <= most for a, b in found)
        root = {x: x for x in prints}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in found:
            root[max(find(a), find(b))] = min(find(a), find(b))
        assert {x: find(x) for x in set(prints)} == plain_components(prints, most)
    with pytest.raises(ValueError):
        sh.links(df, 4)


@pytest.mark.parametrize("column,row", [(2_000, 8_000), (3, 7), (40, 5)])
def test_a_crowded_anchor_is_dealt_over_a_grid(spark, column, row):
    """700 fingerprints close to one point: a forest of links, whatever the cells."""
    r = np.random.default_rng(11)
    base, prints = 0x0123456789ABCDEF, set()
    while len(prints) < 700:
        x = base
        for b in r.choice(64, int(r.integers(0, 5)), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(5)
    out = sh.links(df, 3, column, row).df.collect()
    want = plain_components(prints)
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in ((a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in out):
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {x: find(x) for x in prints} == want
    pairs = sum((a ^ b).bit_count() <= 3 for a in prints for b in prints) // 2
    assert column < 2_000 or len(out) < pairs


def test_groups_of_odd_and_empty_tables(spark, odd, empty):
    got = sorted(((r.doc_id, r.component_id) for r in sh.near_groups(odd).collect()), key=str)
    assert got == [(5, 5), (5, 5), (5, 5), (7, 7), (None, 7), (None, None)]
    assert sh.near_groups(empty).count() == 0
    named = spark.createDataFrame([("b", "one two three four"), ("a", "one two three four"), (None, "one two three four")], "doc_id string, text string")
    assert {r.component_id for r in sh.near_groups(named).collect()} == {"a"}


# Target sample


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_sample(rows, target, share=5, least=20):
    made = {i: plain_features(t) for i, t in rows}
    s, t = Counter(b for _, f in made.values() for b in f), Counter(b for x in target for b in plain_features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    out = {}
    for i, (_, f) in made.items():
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out[i] = [len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    fit = sorted((i for i, (n, _) in made.items() if n >= least), key=lambda i: (-out[i][2], i))
    for k, i in enumerate(fit[: share * len(fit) // 100], 1):
        out[i][3] = k
    return out


@pytest.mark.parametrize("share", [5, 40, 100])
def test_sample_equals_the_plain_version(spark, docs, rows, share):
    target = ["the passage and w1 w2 w3 Ofer thand", None, "", "ça maïs 日本 w7"]
    df = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in im.resample(docs, df, share=share).collect()}
    want = plain_sample(rows, target, share)
    assert got == want and sum(x[3] is not None for x in want.values()) >= share * 30 // 100


def test_sample_of_odd_and_empty_tables(spark, odd, empty, docs):
    got = im.resample(odd, empty, share=100, least_words=2).collect()
    assert len(got) == 6 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    assert all(r.weight == 0 and r.n_features == 0 for r in got if r.doc_id == 7) and im.resample(empty, docs).count() == 0
    nobody = {r.n_features: r.score - r.weight for r in got if r.doc_id is None}
    assert len(nobody) == 2 and len(set(nobody.values())) == 1


def test_crc_of_joined_words():
    r = np.random.default_rng(3)
    words = [bytes(r.integers(97, 123, n).astype(np.uint8)) for n in [*range(1, 70), 300, 4096, 70_001]]
    a, b = words, words[::-1]
    crc = lambda x: np.array([zlib.crc32(w) for w in x], np.uint32)
    got = im.crc_then(crc(a), crc(b), np.array([len(w) for w in b]))
    assert got.tolist() == [zlib.crc32(x + b" " + y) for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize("most,buckets", [(1, 7), (2, 40_000), (4, 10_000)])
def test_buckets_of_runs(spark, most, buckets):
    texts = ["One two, THREE four", "A\x00b\x7fc d9", "é" * 40 + " über über", "x " * 3000, None, "--"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, sorted(r.buckets)) for r in im.bucketed(df, most, buckets).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ))
        assert got[i] == (len(w), sorted(zlib.crc32(" ".join(w[j : j + k]).encode()) % buckets for k in range(1, most + 1) for j in range(len(w) - k + 1)))
