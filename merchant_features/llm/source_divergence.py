"""How the sources of a language differ in their words: a divergence audit on a three-dimensional cube.

A group is a (language, source). With ``p`` a group's smoothed share of a term
in parts per thousand million, two groups differ by the sum of
``(p - q)^2 / (p + q)`` over all kept terms, in whole numbers.

1. Tasks count words by group and term before anything is shuffled; a window
   over the groups of a term keeps the terms found in enough documents.
2. The pairs of groups and the terms span a cube. It is cut into cells of a
   block of groups, another (or the same) block of groups, and a block of terms;
   blocks hold about ``GROUP_BLOCK`` groups and ``TERM_BLOCK`` terms, so a cell
   is bounded however large the corpus is. A group's slice of terms is
   replicated to the cells of its block.
3. A cell sums its pairs over its terms, the terms that none of its groups has
   in one product. The partial sums are added along the term axis.

Besides the pairs, each group's most typical terms are ranked against the
language as a whole.

Defined cases: null text, language and source are empty strings. A group
without words takes part with counts of 0; a language without kept terms has
divergences of 0. Repeated rows count each. An empty table gives no rows. Names
of other columns do not matter. Counts are exact: products are decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.llm import words as W
from merchant_features.sources.storage import materialize

GROUP_BLOCK = 64
TERM_BLOCK = 4096
#: Distinct (group, term) rows that a task holds before it passes them on, and bytes of text that it reads at a time.
HELD_TERMS = 120_000
SLICE_BYTES = 1 << 19
#: Shares are in parts of this.
UNIT = 1_000_000_000


def _slice_terms(part: W.Slice, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, occurrences, documents) of a slice, ``group`` one number per document."""
    w = W.words(part, W.LETTERS)
    document = w.document()
    order = np.lexsort((w.hashes, document))
    d, h = document[order], w.hashes[order]
    heads = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])))) if len(d) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate((heads, [len(d)])))
    g, h, word = group[d[heads]], h[heads], order[heads]
    order = np.lexsort((h, g))
    g, h, n, word = g[order], h[order], n[order], word[order]
    heads = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])))) if len(g) else np.zeros(0, np.int64)
    word = word[heads]
    lengths = w.ends[word] - w.starts[word]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths) + np.repeat(w.starts[word], lengths)
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(w.lower[at].tobytes())]
    terms = pa.Array.from_buffers(pa.large_string(), len(word), buffers)
    totals = np.add.reduceat(n, heads) if len(heads) else n
    return g[heads], terms, totals, np.diff(np.concatenate((heads, [len(g)])))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df); ``docs`` has lang, source and text, none of them null."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term"]

        def flushed(held: list[pa.Table]) -> pa.Table:
            summed = pa.concat_tables(held).group_by(names).aggregate([("n", "sum"), ("df", "sum")])
            return summed.rename_columns([c.removesuffix("_sum") for c in summed.column_names]).select([*names, "n", "df"])

        def sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
            small = table.set_column(2, "term", table.column("term").cast(pa.string()))
            yield from small.combine_chunks().to_batches(max_chunksize=50_000)

        held, rows, fresh = [], 0, 0
        for batch in batches:
            lang, source = (batch.column(c).dictionary_encode() for c in (0, 1))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            for part in W.slices(batch.column(2), SLICE_BYTES):
                g, terms, n, df = _slice_terms(part, group[part.rows.start : part.rows.stop])
                if not len(g):
                    continue
                held.append(
                    pa.table(
                        {
                            "lang": lang.dictionary.take(pa.array(g // len(source.dictionary))),
                            "source": source.dictionary.take(pa.array(g % len(source.dictionary))),
                            "term": terms, "n": pa.array(n), "df": pa.array(df),
                        }
                    )
                )
                fresh += len(g)
                if fresh >= HELD_TERMS:
                    held = [flushed(held)]
                    rows, fresh = held[0].num_rows, 0
                    if rows >= HELD_TERMS:
                        yield from sent(held[0])
                        held = []
        if held:
            yield from sent(flushed(held))

    parts = docs.select("lang", "source", "text").mapInArrow(
        counted, "lang string, source string, term string, n bigint, df bigint"
    )
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: str, total: str, terms: str) -> Column:
    """The smoothed share of a term with ``n`` of ``total`` occurrences among ``terms`` terms; 1 where there are none."""
    top = f"cast({UNIT} AS decimal(10,0)) * cast({n} + 2 AS decimal(20,0))"
    return F.expr(f"CASE WHEN {total} + {terms} = 0 THEN 1L ELSE 1 + ({top}) div cast({total} + 2 * {terms} AS decimal(20,0)) END")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Audit:
    """The kept terms of every group, written once, and what is read off them."""

    def __init__(self, docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 10):
        def text(c: str) -> Column:
            return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

        plain = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
        of_term = Window.partitionBy("lang", "term")
        counted = term_counts(plain).select(
            "*", F.sum("n").over(of_term).alias("lang_n"), F.sum("df").over(of_term).alias("found_in")
        )
        entries = materialize(counted.where(F.col("found_in") >= least_docs).select("lang", "source", "term", "n", "lang_n"))
        terms = entries.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        self.terms = materialize(terms)
        langs = self.terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
        totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = plain.select("lang", "source").distinct()
        sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(
            groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups")), "lang"
        )
        zero = F.lit(0).cast("long")
        sized = sized.select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"),
            F.coalesce("v", zero).alias("v"), F.ceil(F.col("n_groups") / GROUP_BLOCK).cast("int").alias("group_blocks"),
        )
        term_blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / TERM_BLOCK)).cast("int")
        self.groups = materialize(
            sized.select(
                "*", term_blocks.alias("term_blocks"), share("0", "total", "v").alias("p_none"),
                F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int").alias("own_block"),
            )
        )
        self.shares = materialize(
            entries.join(self.groups, ["lang", "source"]).select(
                "lang", "source", "term", "n", share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q"),
                "own_block", "group_blocks", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("term_block"),
            )
        )

    def typical_terms(self, most: int = 10) -> DataFrame:
        """(lang, source, term, value, rank): the terms a group uses more than its language does."""
        valued = self.shares.where("n > 0 AND p > q").withColumn("value", divergence("p", "q"))
        best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("term"))
        ranked = valued.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
        return ranked.select("lang", "source", "term", "value", "rank")

    def pairs(self) -> DataFrame:
        """(lang, a, b, value): every two sources of a language once."""
        sizes = materialize(
            self.terms.join(self.groups.select("lang", "term_blocks").distinct(), "lang")
            .groupBy("lang", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("term_block"))
            .agg(F.count(F.lit(1)).alias("block_terms"))
        )
        # a row per group in every cell of its own, so that cells know all their groups, and a row per count
        heads = (
            self.groups.withColumn("term_block", F.explode(F.expr("sequence(0, term_blocks - 1)")))
            .join(sizes, ["lang", "term_block"], "left")
            .select(
                "lang", "source", F.lit(None).cast("string").alias("term"), F.col("p_none").alias("p"), "own_block",
                "group_blocks", "term_block", F.coalesce("block_terms", F.lit(0)).cast("long").alias("block_terms"),
            )
        )
        counts = self.shares.select(
            "lang", "source", "term", "p", "own_block", "group_blocks", "term_block", F.lit(None).cast("long").alias("block_terms")
        )
        cells = heads.unionByName(counts).withColumn("other", F.explode(F.expr("sequence(0, group_blocks - 1)"))).select(
            "*", F.least("own_block", "other").alias("low"), F.greatest("own_block", "other").alias("high")
        )

        def partial(group: pa.Table) -> pa.Table:
            term, p = group.column("term"), group.column("p").to_numpy()
            is_head = np.array(term.is_null())
            source = group.column("source").combine_chunks().dictionary_encode()
            names, of = source.dictionary, source.indices.to_numpy()
            head = np.zeros(len(names), np.int64)
            none, block = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            head[of[is_head]] = np.flatnonzero(is_head)
            none[of[is_head]] = p[is_head]
            block[of[is_head]] = group.column("own_block").to_numpy()[is_head]
            n_terms = group.column("block_terms")[int(np.flatnonzero(is_head)[0])].as_py()
            coded = term.combine_chunks().filter(pa.array(~is_head)).dictionary_encode()
            shares = np.repeat(none[:, None], len(coded.dictionary), axis=1)
            shares[of[~is_head], coded.indices.to_numpy()] = p[~is_head]
            absent = n_terms - len(coded.dictionary)
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
            a, b, value = [], [], []
            for i in first:
                j = second[second > i] if low == high else second
                if not len(j):
                    continue
                x, y = shares[i][None, :], shares[j]
                found = ((x - y) ** 2 // (x + y)).sum(1) + absent * ((none[i] - none[j]) ** 2 // (none[i] + none[j]))
                a.append(np.full(len(j), i))
                b.append(j)
                value.append(found)
            rows = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b, value)]
            lang = group.column("lang")[0].as_py()
            return pa.table(
                {
                    "lang": pa.array([lang] * len(rows[0]), pa.string()), "a": names.take(pa.array(rows[0])).cast(pa.string()),
                    "b": names.take(pa.array(rows[1])).cast(pa.string()), "value": pa.array(rows[2], pa.int64()),
                }
            )

        partials = cells.groupBy("lang", "low", "high", "term_block").applyInArrow(partial, "lang string, a string, b string, value bigint")
        ordered = partials.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value")
        return ordered.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, **options) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources (`pair`) and typical terms (`term`) of every group."""
    found = Audit(docs, **options)
    pairs = materialize(found.pairs())
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    far = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = both.withColumn("rank", F.row_number().over(far)).withColumn("part", F.lit("pair"))
    terms = found.typical_terms().withColumnRenamed("term", "item").withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.select(*columns).unionByName(terms.select(*columns))
