"""Resampling towards a target: documents drawn by importance weights over hashed word n-grams.

1. Every partition is run through DuckDB, batch by batch: SQL cuts texts into words, a window lines each word
   up with the following ones, and a registered function gives the CRC-32 of every run of one to ``most`` words,
   joined by a blank. A document's buckets (CRC modulo ``buckets``) are spilled to Parquet, so no text is
   read twice.
2. Spark counts the buckets of the source and of the target: a table of ``buckets`` rows at most. A bucket's
   gain is the log of the ratio of its smoothed shares, in whole thousandths; a document weighs the sum of the gains.
3. Weights plus Gumbel noise that follows from seed and key alone are ranked by ranges: the highest ``share`` per cent
   are the sample without replacement, whatever the order, number or deal of the rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Stored, partitions, range_number
from millrace.llm.words import slices

#: ASCII characters that no word holds; every other one, and all beyond ASCII, make words.
BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_FROM, _TO = string.ascii_uppercase + BREAKS, string.ascii_lowercase + " " * len(BREAKS)


def _zero_bytes() -> np.ndarray:
    """What the CRC-32 register becomes after 2**k zero bytes, for k below 32, by its four bytes: shape (32, 4, 256).

    The register is linear over XOR, so the effect on each of its bytes can be looked up by itself.
    """
    bits = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        bits = np.where(bits & 1, (bits >> 1) ^ np.uint32(0xEDB88320), bits >> 1)
    values = np.arange(256, dtype=np.uint32)
    one = lambda r: (r >> np.uint32(8)) ^ bits[r & np.uint32(0xFF)]
    tables = [np.stack([one(values << np.uint32(8 * b)) for b in range(4)])]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return np.stack(tables)


def _through(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return table[0][register & 0xFF] ^ table[1][(register >> 8) & 0xFF] ^ table[2][(register >> 16) & 0xFF] ^ table[3][register >> 24]


_ZEROS = _zero_bytes()


def _after(register: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The register after ``size`` zero bytes."""
    out = register.copy()
    for k in range(int(size.max(initial=0)).bit_length()):
        on = np.flatnonzero(size & (1 << k))
        out[on] = _through(_ZEROS[k], out[on])
    return out


#: Words of fewer bytes than SHORT are followed up by one look into tables of what a blank and so many bytes do.
SHORT = 64
_BLANK = _after(np.full(SHORT, crc32(b" "), np.uint32), np.arange(SHORT))
_LONGER = np.stack([_after((np.arange(256, dtype=np.uint32) << np.uint32(8 * b))[None].repeat(SHORT, 0).ravel(), np.arange(1, SHORT + 1).repeat(256)).reshape(SHORT, 256) for b in range(4)]).ravel()


def crc_then(before: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of x + " " + y, from the CRC-32 of x, that of y, and y's bytes."""
    row = np.minimum(size, SHORT - 1) * 256
    out = _BLANK[np.minimum(size, SHORT - 1)] ^ after
    for b in range(4):
        out ^= _LONGER[row + b * SHORT * 256 + ((before >> np.uint32(8 * b)) & np.uint32(0xFF))]
    long = np.flatnonzero(size >= SHORT)
    if len(long):
        one = np.ones(len(long), np.int64)
        out[long] = _after(_after(before[long], one) ^ np.uint32(crc32(b" ")), size[long]) ^ after[long]
    return out


def _registered(duck) -> None:
    """``zlib_crc32(text)`` and ``crc32_then(crc, crc, bytes)``, both called with whole vectors."""

    def words(column: pa.Array) -> pa.Array:
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        column = column.cast(pa.large_binary())
        edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8).tolist()
        data = column.buffers()[2]
        data = memoryview(data) if data is not None else b""
        return pa.array(np.fromiter([crc32(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)], np.uint32, len(column)))

    def then(before: pa.Array, after: pa.Array, size: pa.Array) -> pa.Array:
        return pa.array(crc_then(*(np.asarray(x).astype(np.uint32) for x in (before, after)), np.asarray(size).astype(np.int64)))

    duck.create_function("zlib_crc32", words, ["VARCHAR"], "UINTEGER", type="arrow")
    duck.create_function("crc32_then", then, ["UINTEGER", "UINTEGER", "BIGINT"], "UINTEGER", type="arrow")


def features_sql(most: int, buckets: int) -> str:
    """(i, n_words, buckets) of the rows (i, text) of the table ``texts``."""
    runs = "".join(f", crc32_then(r{k}, c{k}, n{k}) as r{k + 1}" for k in range(1, most))
    ahead = "".join(f", lead(c, {k}) over o as c{k}, lead(n, {k}) over o as n{k}" for k in range(1, most))
    lists = " || ".join(f"coalesce(list(cast(r{k} % {buckets} as integer)) filter (where r{k} is not null), [])" for k in range(1, most + 1))
    return f"""
        with pieces as (select i, unnest(p) as word, generate_subscripts(p, 1) as place from (select i, string_split(translate(text, $from, $to), ' ') as p from texts)),
        vocabulary as (select word, zlib_crc32(word) as c, strlen(word) as n from (select distinct word from pieces where word <> '')),
        hashed as (select i, place, c, n from pieces join vocabulary using (word)),
        rows_ahead as (select i, c{ahead} from hashed window o as (partition by i order by place)),
        runs as (select i, c as r1{runs} from rows_ahead),
        counted as (select i, count(*) as n_words, {lists} as buckets from runs group by i)
        select coalesce(n_words, 0) as n_words, coalesce(buckets, []) as buckets from texts left join counted using (i) order by i"""


def bucketed(docs: DataFrame, most: int = 3, buckets: int = 10_000, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with n_words and ``buckets``, the bucket of each run of one to ``most`` words of the whole text.

    Only A-Z are lower-cased. A null text has no words; an empty table gives no rows; repeated rows stay.
    """
    keep = ["doc_id"] if keep is None else keep
    if {"n_words", "buckets"} & set(keep):
        raise ValueError("n_words and buckets are columns of the result")
    sql = features_sql(most, buckets)
    kind = "smallint" if buckets <= 1 << 15 else "int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        duck = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": "", "preserve_insertion_order": False})
        _registered(duck)
        number = pa.int16() if kind == "smallint" else pa.int32()
        for batch in batches:
            for at, to in slices(batch.column(text), 1_000_000):
                part = batch.slice(at, to - at)
                texts = pa.table({"i": pa.array(range(part.num_rows), pa.int64()), "text": part.column(text).fill_null("")})
                duck.register("texts", texts)
                found = duck.execute(sql, {"from": _FROM, "to": _TO}).to_arrow_table().combine_chunks()
                duck.unregister("texts")
                lists = found["buckets"].chunk(0).cast(pa.list_(number))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), found["n_words"].chunk(0).cast(pa.int64()), lists], names=[*keep, "n_words", "buckets"])
        duck.close()

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, *([text] if text not in keep else [])).mapInArrow(run, ", ".join([*fields, "n_words long", f"buckets array<{kind}>"]))


def bucket_counts(features: DataFrame) -> dict[int, int]:
    """How many runs fall into each bucket, added by tasks before the shuffle; the driver gets a row a bucket."""
    return {r.b: r.n for r in features.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) for each of B buckets, in doubles."""
    at = np.arange(buckets).tolist()
    s, t = np.array([source.get(b, 0) for b in at], np.float64), np.array([target.get(b, 0) for b in at], np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), with u from the first 32 bits of the SHA-256 of '<seed>:<key>'; a null key is ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def weighed(features: DataFrame, gain: list[int], seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Key, n_words, n_features, weight and score of each document; ``gain`` has a fixed number of entries."""
    table = F.from_json(F.lit(str(gain)), "array<bigint>")
    weight = F.aggregate("buckets", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b.cast("int")))
    out = features.select(key, "n_words", F.size("buckets").cast("long").alias("n_features"), weight.alias("weight"))
    return out.withColumn("score", F.col("weight") + gumbel(F.col(key), seed))


def drawn(scored: DataFrame, share: float = 5, least_words: int = 20, key: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the floor(share N / 100) highest scores of the N documents with enough words, null for others.

    Equal scores go to the lesser key. Candidates are cut into ranges at quantiles of the score, the ranges'
    counts make each range's first rank, and only ranges that the draw reaches are sorted, each in a task.
    """
    spark = scored.sparkSession
    fit = F.col("n_words") >= least_words
    n = 4 * partitions(spark)
    top = [1 - 2 * share / 100 * (i / n) for i in range(1, n)] if share <= 40 else [1 - i / n for i in range(1, n)]
    cuts = sorted(set(scored.where(fit).agg(F.percentile_approx("score", top, 20_000)).first()[0] or []))
    number = range_number(F.col("score"), cuts)
    counts = {r.p: r.n for r in scored.where(fit).groupBy(number.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    quota = int(Fraction(str(share)) * sum(counts.values()) / 100)
    first, before = [0] * (len(cuts) + 1), 0
    for p in range(len(cuts), -1, -1):
        first[p] = before
        before += counts.get(p, 0)
    reached = [p for p, f in enumerate(first) if f < quota]
    least = min(reached, default=len(cuts) + 1)
    in_reach = fit & (number >= least)
    offsets = F.from_json(F.lit(str(first)), "array<bigint>")
    order = Window.partitionBy("_p").orderBy(F.col("score").desc(), F.col(key).asc_nulls_last())
    ranked = scored.where(in_reach).withColumn("_p", number).withColumn("rank", F.row_number().over(order) + F.get(offsets, F.col("_p")))
    ranked = ranked.select(*scored.columns, F.when(F.col("rank") <= quota, F.col("rank")).cast("long").alias("rank"))
    return ranked.unionByName(scored.where(~in_reach).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, share: float = 5, least_words: int = 20, most: int = 3, buckets: int = 10_000, seed: int = 42, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, n_features, weight, score and rank of every document; the drawn ones have a rank.

    Null and empty texts have no features, weight 0 and a score by their noise alone. Rows that share a key are judged one by
    one with the same noise; equal rows take neighbouring ranks. With an empty target all gains follow from the source alone.
    """
    features = Stored(bucketed(docs, most, buckets, text, [key]), "buckets", compression="zstd")
    wanted = bucketed(target.select(F.lit(0).alias("_"), text), most, buckets, text, ["_"])
    gain = gains(bucket_counts(features.df), bucket_counts(wanted), buckets)
    scored = Stored(weighed(features.df, gain, seed, key), "weights")
    features.drop()
    return drawn(scored.df, share, least_words, key).select(key, "n_features", "weight", "score", "rank")
