"""Language identification by segmentation-marginalised unigram models over a fixed public vocabulary.

A language is a distribution over the pieces of the vocabulary. The probability of a word is the sum
over all ways to cut it into pieces, by the forward algorithm; the probability of a text is the
product over its words. Piece probabilities are learned by expectation-maximisation: the expected
number of times each piece is used over all segmentations of the training words (forward-backward).
Words are runs of letters, lower-cased, each with a mark for its begin; a run of more than 24 letters
is cut each 24. Characters outside the vocabulary have a small fixed probability.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import slices
from millrace.llm.worker import only

LONGEST = 24
_MARK = "▁"
_WORDS = None


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, of 24 letters at most."""
    global _WORDS
    if _WORDS is None:
        import regex

        _WORDS = regex.compile(r"\p{L}{1,24}")
    return _WORDS.findall(text.lower())


class Vocabulary:
    """Pieces as rolling hashes: finds which stretches of many words are pieces, at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = sorted({p for p in pieces if p and len(p) <= 16})
        self.longest = max(map(len, self.pieces))
        h = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(h)
        self.hashes, self.numbers = h[order], order.astype(np.int32)
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.hashes >> self.shift).astype(np.int64)] = True

    @staticmethod
    def _hash(p: str) -> int:
        h = 0
        for c in p:
            h = ((h + ord(c) + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)
            h ^= h >> 29
        return h

    def lattice(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, word numbers, piece numbers) of all pieces in the marked words, by start and end.

        Where no piece of one character fits, piece number -1 stands for the unknown character.
        """
        n = len(words)
        width = max(map(len, words)) + 1
        chars = np.zeros((n, width), np.uint64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        sizes = np.fromiter(map(len, words), np.int64, n)
        rows = np.repeat(np.arange(n), sizes)
        cols = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        chars[:, 0] = ord(_MARK) + 1
        chars[rows, cols] = flat
        out = []
        for start in range(width):
            alive = np.flatnonzero(sizes + 1 > start)
            h = np.zeros(len(alive), np.uint64)
            for end in range(start + 1, min(start + self.longest, width) + 1):
                on = sizes[alive] + 1 >= end
                alive, h = alive[on], h[on]
                if not len(alive):
                    break
                h = (h + chars[alive, end - 1]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                some = np.flatnonzero(self.maybe[(h >> self.shift).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
                hit = self.hashes[at] == h[some]
                who, piece = alive[some[hit]], self.numbers[at[hit]]
                if end == start + 1 and len(who) < len(alive):
                    lost = np.setdiff1d(alive, who, assume_unique=True)
                    who, piece = np.r_[who, lost], np.r_[piece, np.full(len(lost), -1, np.int32)]
                if len(who):
                    out.append((start, end, who, piece))
        return out


class UnigramModel:
    """log-probabilities of words under each language; ``probs`` has a row a piece and a column a language, the last row for unknown characters."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], probs: np.ndarray):
        self.vocabulary, self.languages, self.probs = vocabulary, languages, probs
        self.memo: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)), np.float32)
        self.fill = 0

    def forward(self, words: list[str]) -> tuple[np.ndarray, list]:
        lattice = self.vocabulary.lattice(words)
        width = max(map(len, words)) + 2
        alpha = np.zeros((width, len(words), len(self.languages)))
        alpha[0] = 1
        for start, end, who, piece in lattice:  # starts come in ascending order, so alpha[start] is whole
            alpha[end, who] += alpha[start, who] * self.probs[piece]
        return alpha, lattice

    def log_probs(self, words: list[str]) -> np.ndarray:
        alpha, _ = self.forward(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return np.log(alpha[sizes, np.arange(len(words))])

    def places(self, words: list[str], most: int = 250_000) -> np.ndarray:
        """Row of each word in ``scores``; scores what is new, forgets all when it has ``most`` words."""
        need = set(words)
        if len(self.memo) + len(need - self.memo.keys()) > most:
            self.memo, self.fill = {}, 0
        new = sorted(need - self.memo.keys(), key=len)
        if self.fill + len(new) > len(self.scores):
            grown = np.zeros((max(2 * len(self.scores), self.fill + len(new), 10_000), len(self.languages)), np.float32)
            grown[: self.fill] = self.scores[: self.fill]
            self.scores = grown
        for at in range(0, len(new), 8_000):
            part = new[at : at + 8_000]
            self.scores[self.fill : self.fill + len(part)] = self.log_probs(part)
            self.memo.update(zip(part, range(self.fill, self.fill + len(part)), strict=True))
            self.fill += len(part)
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str]) -> tuple[list[str | None], list[float]]:
        """Most probable language of each text, with equal priors, and its posterior; None where there is no letter."""
        parts = [words_of(t) for t in texts]
        flat = [w for p in parts for w in p]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        if not flat:
            return [None] * len(texts), [0.0] * len(texts)
        places = self.places(flat)
        scores = self.scores[places]
        total = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(sizes)
        total[some] = np.add.reduceat(scores.astype(np.float64), (np.cumsum(sizes) - sizes)[some], axis=0)
        total -= total.max(axis=1, keepdims=True)
        post = np.exp(total)
        post /= post.sum(axis=1, keepdims=True)
        best = post.argmax(axis=1)
        return [self.languages[b] if n else None for b, n in zip(best, sizes, strict=True)], [float(post[i, b]) if n else 0.0 for i, (b, n) in enumerate(zip(best, sizes, strict=True))]


def train(pieces: list[str], counts: dict[str, dict[str, int]], rounds: int = 3, smoothing: float = 0.1, unknown: float = 1e-7) -> UnigramModel:
    """Fit piece probabilities to word counts by language. Languages are in sorted order, which also settles ties."""
    vocabulary = Vocabulary(pieces)
    languages = sorted(counts)
    n = len(vocabulary.pieces)
    probs = np.full((n + 1, len(languages)), 1 / n)
    probs[-1] = unknown
    for k, language in enumerate(languages):
        words = sorted(counts[language], key=lambda w: (len(w), w))
        weight = np.array([counts[language][w] for w in words], float)
        for _ in range(rounds):
            model = UnigramModel(vocabulary, [language], probs[:, k : k + 1])
            used = np.zeros(n + 1)
            for at in range(0, len(words), 20_000):
                part = words[at : at + 20_000]
                alpha, lattice = model.forward(part)
                alpha = alpha[:, :, 0]
                sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
                beta = np.zeros_like(alpha)
                beta[sizes, np.arange(len(part))] = 1
                whole = alpha[sizes, np.arange(len(part))]
                p = probs[:, k]
                for start, end, who, piece in reversed(lattice):
                    flow = p[piece] * beta[end, who]
                    beta[start, who] += flow
                    np.add.at(used, piece, weight[at + who] * alpha[start, who] * flow / whole[who])
            used = used[:n] + smoothing
            probs[:n, k] = (1 - unknown) * used / used.sum()
    return UnigramModel(vocabulary, languages, probs)


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model; the mark of a word's begin is kept."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [m.id_to_piece(i).lower() for i in range(m.vocab_size()) if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i))]


def fit(docs: DataFrame, path: str, labelled: Column, per_language: int = 400, text: str = "text", lang: str = "lang", key: str = "doc_id") -> UnigramModel:
    """Learn from whole texts of about ``per_language`` rows of each language among those that ``labelled`` names.

    The sample is by a hash of key and text against each language's share, so it does not depend on the
    order of rows and grows no further with the table; rows that share key, text and language count once. Its word counts come to the driver; their number is
    bounded by the sample. Rows without text or language are left out; without any labelled row there is
    no language and every prediction is ``und``.
    """
    rows = docs.where(labelled & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return UnigramModel(Vocabulary(sentencepiece_pieces(path)), [], np.zeros((0, 0)))
    share = F.xxhash64("key", "text") / F.lit(float(1 << 63))
    keep = F.lit(False)
    for name, n in sorted(sizes.items()):
        keep = keep | ((F.col("lang") == name) & (F.abs(share) < min(1.0, per_language / n)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        only("language counts")
        for b in batches:
            by: dict[str, Counter] = {}
            for language, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(language, Counter()).update(words_of(t))
            for language, c in by.items():
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(c)), pa.array(list(c)), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    counts: dict[str, dict[str, int]] = {name: {} for name in sizes}
    some = rows.where(keep).withColumn("h", F.xxhash64("text")).groupBy("lang", "key", "h").agg(F.first("text").alias("text"))
    got = some.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    for r in got.toLocalIterator():
        counts[r.lang][r.word] = r.n
    return train(sentencepiece_pieces(path), {k: v for k, v in counts.items() if v})


def identify(docs: DataFrame, model: UnigramModel, text: str = "text", key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """(key[, keep columns], lang_pred, score) of every row: language and its posterior, from the text alone.

    A null text, one without letters, and any text when no language was learned give ``und`` and 0. Every
    word of a text counts, however long it is. Other columns are neither read nor in the way.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.vocabulary.pieces, model.languages, model.probs))
    name = uuid.uuid4().hex  # one model a worker process, known by this name
    keep = [c for c in keep or [] if c != key]
    columns = [key, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = only(f"languages {name}", lambda: UnigramModel(Vocabulary(shared.value[0]), *shared.value[1:]))
        for b in batches:
            column = b.column(b.num_columns - 1)
            for at, to in slices(column, 500_000):
                best, score = m.predict([x or "" for x in column.slice(at, to - at).to_pylist()]) if m.languages else ([None] * (to - at), [0.0] * (to - at))
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, to - at) for i in range(len(columns))), pa.array([x or "und" for x in best]), pa.array(score)], names=[f"c{i}" for i in range(len(columns) + 2)])

    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), F.col(text).alias("t"))
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields[:-1])]
    out = rows.mapInArrow(run, ", ".join([*fields, f"c{len(columns)} string", f"c{len(columns) + 1} double"]))
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate([*columns, "lang_pred", "score"])))


def brute_force(model: UnigramModel, text: str) -> list[float]:
    """log-probability of a text under each language by recursion over all segmentations, for tests."""
    number = {p: i for i, p in enumerate(model.vocabulary.pieces)}

    def p(word: str, k: int) -> float:
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, min(len(word), model.vocabulary.longest) + 1):
            if word[:n] in number:
                total += model.probs[number[word[:n]], k] * p(word[n:], k)
            elif n == 1:
                total += model.probs[-1, k] * p(word[1:], k)
        return total

    return [float(sum(np.log(p(_MARK + w, k)) for w in words_of(text))) for k in range(len(model.languages))]
