"""Removing repeated runs of lines, with DataFrame functions only.

Each three consecutive lines of a text are a window, known by two independent 64-bit hashes of its lines'
hashes. The first occurrence of a window over all texts stays; the lines that later occurrences
cover are removed, overlapping windows merged into one stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    t = F.when(F.col(text) != "", F.col(text))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("k2"), F.col(key).alias("key"), F.coalesce(F.split(t, "\n", -1), F.array().cast("array<string>")).alias("lines"))


def _windows(lines: Column, width: int) -> Column:
    hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("b"), x).alias("b")))

    def window(h: Column) -> Column:
        one = lambda i: F.struct(i.alias("at"), *(F.xxhash64(*(F.get(h, i + k)[f] for k in range(width))).alias(f"w{f}") for f in "ab"))
        return F.when(F.size(h) >= width, F.transform(F.sequence(F.lit(0), F.size(h) - width), one))

    # A lambda over one element, so that the lines are hashed once and not once a window.
    return F.get(F.transform(F.array(hashes), window), 0)


def _outline(starts: Column, width: int) -> tuple[Column, Column]:
    """Where the merged stretches begin, and where they end, from ascending window starts."""
    begins = F.filter(starts, lambda x, i: (i == 0) | (x > F.get(starts, i - 1) + width))
    ends = F.transform(F.filter(starts, lambda x, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > x + width)), lambda x: x + width)
    return begins, ends


def drop_repeated_lines(docs: DataFrame, width: int = 3, text: str = "text", key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """(key[, keep columns], n_lines, n_removed, text) of every row; text is what is left, joined by line feeds.

    Lines end at line feeds and are compared as they are. Occurrences are in the order of key (nulls
    first), then a hash of the text, then place; the first stays. A text of fewer than ``width`` lines has no
    window and stays whole; a null or empty text has no lines and its text is empty. Rows that share key
    and text are one text to this operator: they get the same result. Other columns are not read.

    A frequent window is counted before the shuffle; the join that finds its later occurrences has one
    row a window on the other side, so adaptive execution can split it.
    """
    keep = [c for c in keep or [] if c not in (key, text)]
    rows = _keyed(docs, text, key)
    w = rows.select("k1", "k2", F.explode(_windows(F.col("lines"), width)).alias("w")).select("k1", "k2", "w.at", "w.wa", "w.wb")
    firsts = w.groupBy("wa", "wb").agg(F.min(F.struct("k1", "k2", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = w.join(firsts, ["wa", "wb"]).where(F.struct("k1", "k2", "at") != F.col("first"))
    starts = later.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    t = F.when(F.col(text) != "", F.col(text))
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("k2"), F.col(key).alias("key"), t.alias("text"), F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep))).alias("kept"))
    both = texts.join(starts, ["k1", "k2"], "left")
    begins, ends = _outline(F.col("starts"), width)
    both = both.select("key", "kept", F.col("text").alias("whole"), begins.alias("begins"), ends.alias("ends"), F.coalesce(F.split("text", "\n", -1), F.array().cast("array<string>")).alias("lines"))
    n = F.size("lines")
    pieces = F.zip_with(F.concat(F.array(F.lit(0)), "ends"), F.concat("begins", F.array(n)), lambda a, b: F.slice("lines", a + 1, b - a))
    removed = F.coalesce(F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0), lambda s, x: s + x), F.lit(0))
    left = F.coalesce(F.when(F.col("begins").isNull(), F.col("whole")).otherwise(F.array_join(F.flatten(pieces), "\n")), F.lit(""))
    return both.select(F.col("key").alias(key), *(F.col(f"kept.c{i}").alias(c) for i, c in enumerate(keep)), n.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), left.alias(text))


def duckdb_sql(table: str = "documents", width: int = 3) -> str:
    """The same rows by DuckDB, for tables whose keys are unique and not null."""
    leads = ", ".join(f"lead(line, {k}) over d as l{k}" for k in range(1, width))
    names = ", ".join(["line", *(f"l{k}" for k in range(1, width))])
    return f"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from {table} where text <> ''
), led as (
  select doc_id, pos, line, {leads}, count(*) over (partition by doc_id) as n from lines
  window d as (partition by doc_id order by pos)
), ranked as (
  select doc_id, pos, row_number() over (partition by {names} order by doc_id, pos) as nth
  from led where pos <= n - {width - 1}
), covered as (
  select distinct doc_id, pos + k as pos from ranked, (select unnest(range({width})) as k) where nth > 1
)
select t.doc_id, count(l.pos) as n_lines, count(c.pos) as n_removed,
  coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where c.pos is null), '') as text
from {table} t left join lines l on l.doc_id = t.doc_id left join covered c on c.doc_id = l.doc_id and c.pos = l.pos
group by t.doc_id"""


def brute_force(rows: list[tuple[int | None, str | None]], width: int = 3) -> list[tuple[int, int, str]]:
    """(n_lines, n_removed, text) of rows with distinct keys, for tests."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen: set[tuple] = set()
    out: dict[int, tuple[int, int, str]] = {}
    for i in order:
        lines = rows[i][1].split("\n") if rows[i][1] else []
        hit = [False] * len(lines)
        for k in range(len(lines) - width + 1):
            w = tuple(lines[k : k + width])
            if w in seen:
                hit[k : k + width] = [True] * width
            seen.add(w)
        out[i] = (len(lines), sum(hit), "\n".join(x for x, h in zip(lines, hit, strict=True) if not h))
    return [out[i] for i in range(len(rows))]
