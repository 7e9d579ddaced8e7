"""How the sources of each language differ, by the terms that they use more or less often.

1. A task counts terms of its texts by (language, source), with the number of texts that hold each, before anything is
   shuffled. Terms in too few texts of their language go.
2. Each term of a language is pivoted into a wide vector: its counts in an array indexed by the language's sources. Terms
   with equal vectors count the same everywhere, so a vector is kept once with the number of its terms.
3. Higher-order functions turn a vector's counts into shares of each source and emit contributions for the pairs of
   sources of which one at least has the term; tasks add these up before the shuffle. What the terms that both lack
   contribute is the same for each of them, so they are counted and not emitted.

Shares are whole billionths, and all arithmetic is on integers: results do not depend on the deal of the rows.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Stored, partitions

#: A-Z become a-z, other bytes below 128 separate terms, and all others are their letters.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
SCALE = 1_000_000_000


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", most_held: int = 300_000) -> DataFrame:
    """(lang, source, term, n, texts), several rows of a term at most a task; nulls are ''.

    A task holds ``most_held`` terms at most, beside those of one text, and hands on what it has beyond.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (l, s), (n, texts) in held.items():
                terms = list(n)
                for at in range(0, len(terms), 20_000):
                    part = terms[at : at + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([l] * len(part)), pa.array([s] * len(part)), pa.array([t.decode("utf-8", "replace") for t in part]), pa.array([n[t] for t in part], pa.int64()), pa.array([texts[t] for t in part], pa.int64())],
                        names=["lang", "source", "term", "n", "texts"],
                    )
            held.clear()

        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())
            for t, l, s in zip(column, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = (t.as_py() or b"").translate(_TERM_BYTES).split()
                n, texts = held.setdefault((l or "", s or ""), (Counter(), Counter()))
                size -= len(n)
                n.update(found)
                texts.update(set(found))
                size += len(n)
                if size > most_held:
                    yield from out()
                    size = 0
        yield from out()

    return docs.select(text, F.col(lang).cast("string"), F.col(source).cast("string")).mapInArrow(run, "lang string, source string, term string, n long, texts long")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + terms)), exact for counts of any size; NULL where a language keeps no term."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(count + 1) * F.lit(SCALE).cast("decimal(10,0)"), F.nullif(wide(total + terms), F.lit(0).cast("decimal(19,0)"))) + 1


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); shares are below 2**30 + 1, so a square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, least_texts: int = 3, most_ranks: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for each source of each language.

    Part ``pair``: each other source of the language, with the sum of ``excess`` of the source's shares over the other's, over all kept
    terms. Part ``term``: the terms that the source has and uses more than the language at large, by their excess over it, up to
    ``most_ranks``. Ranks go from 1 by falling value, equal values by item. A null language, source or text is ''. Rows count as texts
    whether or not their ids repeat; other columns are not read; an empty table gives no rows. A source without a kept term takes
    part with counts of 0, and a language that keeps none has pairs of value 0. Sources of a language stand in one array, as
    the result has a row for each pair of them.
    """
    groups = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    numbered = Stored(groups.groupBy("lang").agg(F.array_sort(F.collect_list("source")).alias("sources")), "sources")
    # A task has one row of a term, source and language at most each time it hands on, so no term is hot, and one shuffle serves both groupings.
    counted = term_counts(docs, text, lang, source).repartition(partitions(docs.sparkSession), "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    terms = counted.groupBy("lang", "term").agg(F.sum("texts").alias("texts"), F.collect_list(F.struct("source", "n")).alias("p")).where(F.col("texts") >= least_texts)
    placed = terms.join(numbered.df, "lang").select("lang", "term", F.array_sort(F.transform("p", lambda x: F.struct((F.array_position("sources", x["source"]) - 1).cast("int").alias("at"), x["n"].alias("n")))).alias("p"))
    kept = Stored(placed.select("lang", "term", F.col("p.at").alias("ats"), F.col("p.n").alias("ns")), "terms", compression="zstd")

    totals = kept.df.select("lang", F.explode(F.arrays_zip("ats", "ns")).alias("p")).groupBy("lang", F.col("p.ats").alias("at")).agg(F.sum("p.ns").alias("total"))
    by_lang = totals.groupBy("lang").agg(F.collect_list(F.struct("at", "total")).alias("found"), F.sum("total").alias("whole"))
    sizes = kept.df.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    langs = numbered.df.join(by_lang, "lang", "left").join(sizes, "lang", "left")
    wide = lambda found, n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.element_at(F.map_from_entries(found), i), F.lit(0).cast("long")))
    no_places = F.array().cast("array<struct<at:int,total:bigint>>")
    langs = Stored(langs.select("lang", "sources", wide(F.coalesce("found", no_places), F.size("sources")).alias("totals"), F.coalesce("whole", F.lit(0)).cast("long").alias("whole"), F.coalesce("v", F.lit(0)).cast("long").alias("v")), "languages")
    pairs, over = pair_sums(kept.df, langs.df), term_excess(kept.df, langs.df)

    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(over.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= most_ranks))
    out = Stored(ranked.select("lang", "source", "part", "item", "value", "rank"), "divergence")
    for t in (numbered, kept, langs):
        t.drop()
    return out.df


def pair_sums(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) for each two different sources of a language, in both orders."""
    vectors = kept.groupBy("lang", "ats", "ns").agg(F.count(F.lit(1)).alias("terms"))
    here = vectors.join(langs.select("lang", "totals", "v"), "lang")
    # The wide vector of shares: by the count where the term occurs, the bare share elsewhere.
    count = lambda i: F.coalesce(F.get("ns", (F.array_position("ats", i) - 1).cast("int")), F.lit(0).cast("long"))
    wide = here.select("lang", "terms", "ats", F.transform("totals", lambda t, i: share(count(i), t, F.col("v"))).alias("wide"))
    one = wide.select("*", F.explode("ats").alias("g"))
    met = one.select("lang", "terms", "g", "ats", F.get("wide", F.col("g")).alias("p"), F.posexplode("wide").alias("h", "q")).where("g <> h")
    lacks = F.array_position("ats", F.col("h")) == 0
    emitted = met.select("lang", "g", "h", "terms", (excess(F.col("p"), F.col("q")) * F.col("terms")).alias("forth"), F.when(lacks, F.col("terms")).alias("back_terms"), F.when(lacks, excess(F.col("q"), F.col("p")) * F.col("terms")).alias("back"))
    added = emitted.groupBy("lang", "g", "h").agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"), F.sum("terms").alias("m"), F.sum("back_terms").alias("m_back"))
    # (g, h) with the term at g, and (h, g) where only h, the first of that pair, lacks it.
    ways = F.array(F.struct("g", "h", F.col("forth").alias("f"), "m"), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("back").alias("f"), F.col("m_back").alias("m")))
    sums = added.select("lang", F.explode(ways).alias("w")).select("lang", "w.*").where("m is not null").groupBy("lang", "g", "h").agg(F.sum("f").alias("f"), F.sum("m").alias("touched"))

    at = lambda a, i: F.get(a, F.col(i))
    bare = F.transform("totals", lambda t: share(F.lit(0).cast("long"), t, F.col("v")))
    every = langs.select("lang", "sources", "v", bare.alias("bare"), F.posexplode("sources").alias("g", "source")).select("*", F.posexplode("sources").alias("h", "item")).where("g <> h")
    every = every.select("lang", "g", "h", "source", "item", "v", excess(at("bare", "g"), at("bare", "h")).alias("bare_f"))
    zero = F.lit(0).cast("long")
    value = F.when(F.col("v") == 0, zero).otherwise(F.coalesce("f", zero) + (F.col("v") - F.coalesce("touched", zero)) * F.col("bare_f"))
    return every.join(sums, ["lang", "g", "h"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))


def term_excess(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) of each term in each source that has it and uses it more than the language does."""
    n = F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x)
    terms = kept.withColumn("all", n).select("lang", "term", "all", F.explode(F.arrays_zip("ats", "ns")).alias("p"))
    here = terms.join(langs.select("lang", "sources", "totals", "whole", "v"), "lang")
    mine = share(F.col("p.ns"), F.get("totals", F.col("p.ats")), F.col("v"))
    both = here.select("lang", F.get("sources", F.col("p.ats")).alias("source"), F.col("term").alias("item"), mine.alias("p"), share(F.col("all"), F.col("whole"), F.col("v")).alias("q"))
    return both.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", excess(F.col("p"), F.col("q")).alias("value"))


def duckdb_sql(least_texts: int = 3, most_ranks: int = 200) -> str:
    """The same rows in DuckDB's SQL."""
    return f"""
with doc as (select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as t from documents),
words as (select i, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x60\\x7B-\\x7F]+')) as term from doc),
counts as (select lang, source, term, count(*) as n from words group by all),
kept as (select lang, term from words group by lang, term having count(distinct i) >= {least_texts}),
vs as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from doc),
cells as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n from groups g join kept k on g.lang = k.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
shares as (select c.lang, c.source, term, n, 1 + 1000000000::hugeint * (n + 1) // (sum(n) over (partition by c.lang, c.source) + v) as p from cells c join vs on vs.lang = c.lang),
whole as (select lang, term, 1 + 1000000000::hugeint * (n + 1) // (sum(n) over (partition by lang) + v) as q from (select lang, term, sum(n) as n from cells group by all) join vs using (lang)),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from shares join whole using (lang, term) where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (select * from every union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {most_ranks}"""
