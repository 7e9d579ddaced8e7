from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, ordinal, syncmers, urlfilter
from millrace.llm.fmindex import FmIndex, contamination, is_contaminated, suffix_array
from millrace.llm.fmindex import brute_force as contamination_by_hand

PIECES = P.path("piece_bpe_32k.model")


def test_suffix_array_and_search():
    rng = np.random.default_rng(1)
    for n, top in ((1, 3), (50, 2), (400, 3), (3000, 20)):
        s = np.r_[rng.integers(0, top + 1, n), 0]
        place = np.cumsum(s == 0)
        rank = np.where(s == 0, place - 1, place[-1] + s)
        order = sorted(range(len(s)), key=lambda i: rank[i : i + 400].tolist())
        assert suffix_array(s).tolist() == order or n > 400
        index = FmIndex(s, top, sample=4)
        for m in (1, 2, 3):
            phrases = rng.integers(1, top + 1, (40, m))
            lo, hi = index.search(phrases)
            for p, a, b in zip(phrases, lo, hi, strict=True):
                want = [i for i in range(len(s) - m + 1) if (s[i : i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, b))) == want


def test_contamination(spark, docs, rows, odd, empty):
    items = [(1, " ".join((rows[20][1] or "x y").split()[:20])), (2, "one"), (3, None), (4, "!!"), (4, "two words"), (None, "SO on so ON so on so on so on so on so")]
    items += [(10 + i, t) for i, (_, t) in enumerate(rows[30:40])]
    b = spark.createDataFrame(items, "item_id long, text string")
    want = contamination_by_hand(rows, items)
    for size in (16 << 20, 400):
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in contamination(docs, b, block_bytes=size).collect()}
        assert got == want
    out = contamination(docs, b, keep=["doc_id", "text", "n", "key"])
    assert out.columns == ["doc_id", "text", "n", "key", "n_words", "n_hit", "spans", "items"]
    assert out.where("aggregate(transform(spans, s -> s.stop - s.start), 0, (a, x) -> a + x) <> n_hit").isEmpty()
    assert out.where(is_contaminated()).count() == sum(h > 0 and 20 * h >= n for n, h, _ in want.values())
    assert contamination(odd, b).count() == 6 and contamination(empty, b).count() == 0
    assert contamination(docs, b.limit(0)).where("n_hit > 0").isEmpty()


@pytest.fixture(scope="module")
def speech(spark):
    base = {"en": "the thing of thought and other the with that which were ".split(), "de": "der die und schön über straße auch nicht sich ".split(), "fr": "le la être où déjà français avec pour ".split()}
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(base[k], rng.integers(3, 30))), k) for i in range(300) for k in [["en", "de", "fr"][i % 3]]]
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 -- 34", "fr"), (303, "Ω", None), (304, "THE Thing", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(speech, empty):
    learned = F.col("doc_id") % 4 != 2
    model = langid.fit(speech, PIECES, learned, per_language=50)
    got = langid.identify(speech, model, keep=["lang"]).collect()
    named = [r for r in got if r.doc_id < 300 and r.doc_id % 4 == 2]
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in named)
    other = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id >= 300}
    assert other[300] == other[301] == other[302] == ("und", 0.0) and other[304][0] == "en" and other[303][0] != "und"
    assert langid.identify(empty, model).count() == 0
    none = langid.fit(speech.limit(0), PIECES, learned)
    assert {r.lang_pred for r in langid.identify(speech, none).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    model = langid.train(["▁", "▁a", "a", "b", "ab", "▁ab", "ba"], {"x": {"ab": 5, "abab": 1}, "y": {"ba": 3, "b": 2}})
    for text in ("ab", "abba ba", "abzab", "b" * 30):
        words = langid.words_of(text)
        np.testing.assert_allclose(model.log_probs(words).sum(axis=0), langid.brute_force(model, text), rtol=1e-9)
    again = langid.train(["▁", "▁a", "a", "b", "ab", "▁ab", "ba"], {"x": {"ab": 5, "abab": 1}, "y": {"ba": 3, "b": 2}})
    assert (again.probs == model.probs).all()


def test_more_rounds_fit_better():
    counts = {"x": {"the": 10, "then": 4, "other": 3}}
    pieces = langid.sentencepiece_pieces(PIECES)
    fit = [float((langid.train(pieces, counts, rounds=n, smoothing=0.0).log_probs(["the", "then", "other"])[:, 0] * [10, 4, 3]).sum()) for n in (1, 3)]
    assert fit[1] >= fit[0]


URLS = [
    ("http://a.Example.COM/en/7x", "a.example.com", "/en/7x", "example.com/en/7", "allow"),
    ("https://example.com/en/6?q=http://x.org/es/", "example.com", "/en/6", "com/en/", "block"),
    ("http://x.net/de/8", "x.net", "/de/8", "net/de/", "allow"),
    ("http://b.example.net/de/80#f", "b.example.net", "/de/80", "example.net/de/8", "block"),
    ("ftp://notexample.net/de/8/", "notexample.net", "/de/8/", "net/de/", "allow"),
    ("http://org/es/1", "org", "/es/1", "org/es/", "block"),
    ("http://borg/es/1", "borg", "/es/1", None, None),
    ("http://best-poker.example.net/fr/1", "best-poker.example.net", "/fr/1", None, "block"),
    ("https://library.example.org/fr/1", "library.example.org", "/fr/1", None, "allow"),
    (None, "", "", None, None),
    ("no scheme.com/en/1", "", "", None, None),
    ("http://?x", "", "", None, None),
    ("://h/p", "h", "/p", None, None),
    ("http://ÄB.de/ß", "Äb.de", "/ß", None, None),
]


def test_url_rules_and_model(spark):
    weights = urlfilter.fit(urlfilter.labelled_table(spark))
    df = spark.createDataFrame([(i, u, "h", "v") for i, (u, *_) in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in urlfilter.judge(df, weights).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in (["allow", "block"] if verdict is None else [verdict])
    train = urlfilter.labelled_table(spark)
    p = urlfilter.probability(urlfilter.grams(urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url")), len(weights) - 1), weights)
    assert train.where((p >= 0.5).cast("int") == F.col("label")).count() > 0.97 * train.count()
    assert urlfilter.judge(df.limit(0), weights).count() == 0
    assert set(urlfilter.fit(train.limit(0))) == {0.0}


def test_url_model_on_names_it_has_not_seen(spark):
    """A third of the names and of the paths to block is held out; neither stands in the table that the model is fitted to."""
    train, test = urlfilter.labelled_urls((0, 1)), urlfilter.labelled_urls((2,))
    assert not {u for u, _ in train} & {u for u, _ in test} and len(train) + len(test) == len(urlfilter.labelled_urls())
    weights = urlfilter.fit(urlfilter.labelled_table(spark, (0, 1)))
    p = urlfilter.probability(urlfilter.grams(urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url")), len(weights) - 1), weights)
    said = [(r.label, r.p >= 0.5) for r in spark.createDataFrame(test, "url string, label int").select("label", p.alias("p")).collect()]
    blocked = [y for y, b in said if b]
    assert sum(blocked) / len(blocked) > 0.85 and sum(blocked) / sum(y for y, _ in said) > 0.7, (sum(blocked), len(blocked), sum(y for y, _ in said))


def test_url_paths_count(spark):
    weights = urlfilter.fit(urlfilter.labelled_table(spark))
    rows = [(1, "http://www.library.example.com/cheap-pills/5"), (2, "http://www.library.example.com/recipes/soup/5"), (3, "http://shorelain.example.org/about"), (4, "https://m.casino-hot.example.org/about")]
    got = {r.page_id: r.verdict for r in urlfilter.judge(spark.createDataFrame(rows, "page_id int, url string"), weights).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def test_url_weights_are_at_the_optimum(spark):
    """The gradient of the stated loss vanishes there."""
    rows = [("http://aaa.com/x", 1), ("http://aabb.com/yes", 1), ("http://zzz.org/x/z", 0), ("http://zzz.org/x/z", 1), (None, 1), ("http://q.com/", None)]
    dims, decay = 64, 0.01
    df = spark.createDataFrame(rows, "url string, label int")
    w = np.array(urlfilter.fit(df, dims, decay, 500))
    g = df.where("url is not null and label is not null").select("label", urlfilter.grams(urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url")), dims).alias("g")).collect()
    x = np.zeros((len(g), dims + 1))
    for i, r in enumerate(g):
        x[i, r.g] = 1 / np.sqrt(len(r.g))
    y = np.array([r.label for r in g])
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    assert len(g) == 4 and np.abs(w).max() > 0.1
    np.testing.assert_allclose(x.T @ (share * (1 / (1 + np.exp(-x @ w)) - y)) + decay * w, 0, atol=1e-5)
    assert set(urlfilter.fit(df.where("label = 1"), dims, decay)) != {0.0}


def test_grades(spark, empty):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(200)]

    def text(grade):
        w = list(rng.choice(words, 60))
        if grade == 0:
            w[5] = "Vile"
        if grade == 1:
            w = [x.upper() + "!!" for x in w]
        return " ".join(w)

    grades = rng.integers(0, 3, 900)
    d = spark.createDataFrame([(i, text(g), "x") for i, g in enumerate(grades)] + [(900, None, "x"), (901, "", "x"), (None, "w1", "x")], "doc_id long, text string, grade string")
    r = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades) if i < 600] + [(None, 1), (5, None)], "doc_id long, grade int")
    model = ordinal.fit(d, r)
    assert (np.diff(model.thresholds) >= 0).all() and model.grades == [0.0, 1.0, 2.0]
    got = {x.doc_id: x for x in ordinal.grade_documents(d, model, tail=2).collect()}
    assert len(got) == 903
    right = [got[i].keep == (grades[i] == 2) for i in range(600, 900)]
    assert np.mean(right) > 0.97
    means = [np.mean([got[i].expected_grade for i in range(600, 900) if grades[i] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert ordinal.grade_documents(empty, model, tail=2).count() == 0
    none = ordinal.fit(d, r.limit(0))
    assert ordinal.grade_documents(d, none, tail=2).count() == 903


def test_fit_of_thresholds_equals_plain_descent():
    """The same steps written out text by text, with probabilities from their definition."""
    rng = np.random.default_rng(3)
    texts = [np.unique(rng.integers(0, 16, rng.integers(1, 9))) for _ in range(60)]
    y = np.array([int(np.clip(len(set(t) & {1, 2}) - len(set(t) & {3}) + rng.integers(0, 2), 0, 2)) for t in texts])
    rounds, rate, sparsity, least = 25, 0.3, 0.002, 5
    m = ordinal.CumulativeLink.fit(texts, y, [0.0, 1.0, 2.0], 4, rounds, rate, sparsity, least)
    often = {f for f in range(16) if sum(f in t for t in texts) >= least}
    below = [min(max(sum(y <= j) / 60, 1e-3), 1 - 1e-3) for j in (0, 1)]
    w, cut = [0.0] * 16, [float(np.log(b / (1 - b))) + j * 1e-6 for j, b in enumerate(below)]
    past, past_cut = [1e-6] * 16, [1e-6] * 2
    for _ in range(rounds):
        g, gc = [0.0] * 16, [0.0] * 2
        for t, k in zip(texts, y, strict=True):
            score = sum(w[f] for f in t if f in often)
            at = lambda j: 0.0 if j < 0 else 1.0 if j > 1 else 1 / (1 + np.exp(score - cut[j]))  # noqa: B023, E731
            p = max(at(k) - at(k - 1), 1e-12)
            slope = lambda j: at(j) * (1 - at(j))  # noqa: B023, E731
            for f in t:
                if f in often:
                    g[f] += (slope(k - 1) - slope(k)) / p / 60  # of the log-likelihood
            if k < 2:
                gc[k] += slope(k) / p / 60
            if k > 0:
                gc[k - 1] -= slope(k - 1) / p / 60
        for f in range(16):
            past[f] += g[f] ** 2
            w[f] += rate * g[f] / past[f] ** 0.5
            w[f] = np.sign(w[f]) * max(abs(w[f]) - rate * sparsity / past[f] ** 0.5, 0)
        for j in range(2):
            past_cut[j] += gc[j] ** 2
            cut[j] += rate * gc[j] / past_cut[j] ** 0.5
        cut.sort()
    np.testing.assert_allclose(m.weights, w, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(m.thresholds, cut, rtol=1e-6)
    assert np.abs(m.weights).max() > 0.1
    expected, tail = m.judge(np.array([0.3]), 2)
    c0, c1 = (1 / (1 + np.exp(0.3 - t)) for t in m.thresholds)
    np.testing.assert_allclose([expected[0], tail[0]], [(c1 - c0) + 2 * (1 - c1), 1 - c1])


def test_grade_query_equals_a_plain_scorer(spark):
    """Scores of whole texts from the model's weights, with features found by regular expressions."""
    import re

    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["Good", "bad!", "WORSE", "x1", "über", "a,b"], rng.integers(0, 9))) for _ in range(80)] + [None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = ordinal.fit(d, spark.createDataFrame([(i, int(i % 3)) for i in range(80)], "doc_id long, grade int"), bits=12)
    number = {}  # feature numbers of single words and shapes, from texts of one word each

    def feature_numbers(word):
        if word not in number:
            number[word] = set(ordinal.features(__import__("pyarrow").array([word]), 12)[1].tolist())
        return number[word]

    shape = lambda w: re.sub(r"(.)\1+", r"\1", "".join("A" if "A" <= c <= "Z" else "a" if c.isalpha() else "9" if c.isdigit() else c for c in w))
    got = {r.doc_id: r for r in ordinal.grade_documents(d, model, tail=2).collect()}
    for i, t in enumerate(texts):
        found = set().union(*(feature_numbers(w) for w in (t or "").split())) if t else set()
        assert len(found) <= len({*re.findall(r"[^\W_]+", (t or "").lower())}) + len({shape(w) for w in (t or "").split()})
        score = sum(float(np.float32(model.weights[f])) for f in found)
        below = [1 / (1 + np.exp(score - c)) for c in model.thresholds]
        probability = np.diff([0.0, *below, 1.0])
        assert abs(got[i].expected_grade - probability @ np.array(model.grades)) < 1e-9
        assert abs(got[i].tail_probability - probability[2]) < 1e-9 and got[i].keep == (probability[2] >= 0.5)


def test_anchors_by_definition():
    """Closed syncmers, fingerprints and likeness from their definitions, run by run in plain Python."""
    base, mask = syncmers._BASE, (1 << 64) - 1

    def run_hash(data, seed):
        return int(syncmers.mix(np.array([sum(int(syncmers._BYTE[c]) * pow(base, i, 1 << 64) for i, c in enumerate(data)) & mask], np.uint64), seed)[0])

    def plain(text, k, s, size):
        found = {}
        for i in range(len(text) - k + 1):
            inner = [run_hash(text[i + j : i + j + s], 3) for j in range(k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                found.setdefault(run_hash(text[i : i + k], 4) >> 32, i)
        return sorted(((i, h) for h, i in sorted(found.items())[:size]))

    def like(a, b, size):
        if not a or not b:
            return float(len(a) == len(b))
        union = sorted({h for _, h in a} | {h for _, h in b})[:size]
        place = {h: i for i, h in b}
        chain = [place[h] for _, h in a if h in place and h in union]
        best = [1] * len(chain)
        for i in range(len(chain)):
            best[i] = 1 + max((best[j] for j in range(i) if chain[j] < chain[i]), default=0)
        return max(best, default=0) / len(union)

    rng = np.random.default_rng(9)
    text = bytes(rng.integers(97, 101, 160).tolist())
    texts = [text, text[:70] + b"zz" + text[70:], text[60:] + text[:60], b"abc", b"", b"ab" * 40, bytes(rng.integers(0, 256, 90).tolist())]
    for k, s, size in ((8, 3, 64), (12, 5, 10)):
        got = syncmers.fingerprints(texts, k, s, size)
        want = [plain(t, k, s, size) for t in texts]
        for t, (h, at), w in zip(texts, got, want, strict=True):
            if w:
                assert list(zip(at.tolist(), h.tolist(), strict=True)) == w
            else:
                assert len(h) == (1 if t else 0)
        for a, x in zip(got, want, strict=True):
            for b, y in zip(got, want, strict=True):
                if (x and y) or not (len(a[0]) and len(b[0])):
                    assert syncmers.likeness(a, b, size) == like(x, y, size) or not (x and y)


def test_fingerprints(docs, rows, odd, empty):
    got = {r.doc_id: r for r in syncmers.fingerprint_pairs(docs).collect()}
    texts = [t or "" for _, t in rows]
    prints = [syncmers.fingerprints([t.encode()])[0] for t in texts]
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        e = syncmers.edited(t, following)
        f = syncmers.fingerprints([e.encode()])[0]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (syncmers.as_text(prints[i]), syncmers.as_text(f))
        assert (r.near_edited, r.near_next) == (syncmers.likeness(prints[i], f), syncmers.likeness(prints[i], prints[(i + 1) % len(texts)]))
    assert syncmers.fingerprint_pairs(odd).count() == 6 and syncmers.fingerprint_pairs(empty).count() == 0
    assert syncmers.fingerprint_pairs(odd.limit(0).unionAll(odd.where("doc_id = 7"))).first().near_next == 1.0


def test_anchors_do_not_depend_on_surroundings():
    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 123, 3000).tolist())
    a, at, h = syncmers.anchors(np.frombuffer(text, np.uint8), np.array([0, 3000]), 24, 8)
    inner = text[500:2000]
    _, at2, h2 = syncmers.anchors(np.frombuffer(inner, np.uint8), np.array([0, 1500]), 24, 8)
    inside = (at >= 500) & (at + 24 <= 2000)
    assert (h[inside] == h2).all() and (at[inside] - 500 == at2).all() and len(h2) > 50
    same = syncmers.fingerprints([text])[0]
    assert syncmers.likeness(same, same) == 1.0 and syncmers.likeness(same, syncmers.fingerprints([text[::-1]])[0]) < 0.1
    moved = syncmers.fingerprints([text[:1500] + b"xyz" + text[1500:]])[0]
    assert syncmers.likeness(same, moved) > 0.8
