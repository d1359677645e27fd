"""Divergence of sources within a language: joint tables of term counts by products of one-hot level columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.joins import salted_join
from episodica.llm.words import LOWER, byte_set, text_blocks
from episodica.sources.shared import store

# terms are runs of ASCII letters and all characters from 0x80 on
LETTERS = ~byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
STRIP = 256


def term_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of each term of a block of rows, and the terms by code."""
    data = LOWER[data]
    inside = LETTERS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(inside & np.append(~inside[1:] | edge[1:-1], True)) + 1 if len(data) else starts
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    letters = pa.py_buffer(np.ascontiguousarray(data[inside]))
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), letters).dictionary_encode()
    return np.searchsorted(offsets, starts, "right") - 1, terms.indices.to_numpy().astype(np.int64), terms.dictionary


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (rows that have it) of a table lang, source, text.

    Tasks count within runs of rows first; Spark adds those counts up, partially before the shuffle.
    """

    def run(batches):
        for batch in batches:
            names = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
            codes = [x.indices.to_numpy().astype(np.int64) for x in names]
            many = len(names[1].dictionary)
            group = codes[0] * many + codes[1]
            for at, data, offsets in text_blocks(batch.column("text"), 1 << 22):
                row, term, terms = term_codes(data, offsets)
                if not len(term):
                    continue
                cells, n = np.unique(row * len(terms) + term, return_counts=True)
                row, term = np.divmod(cells, len(terms))
                # a row's group is at most rows squared, so codes of groups are made dense before they meet the terms
                dense, local = np.unique(group[at : at + len(offsets) - 1], return_inverse=True)
                both, place, held = np.unique(local[row] * len(terms) + term, return_inverse=True, return_counts=True)
                where, term = np.divmod(both, len(terms))
                lang, source = np.divmod(dense[where], many)
                yield pa.RecordBatch.from_arrays(
                    [names[0].dictionary.take(pa.array(lang)), names[1].dictionary.take(pa.array(source)), terms.take(pa.array(term)).cast(pa.string()),
                     pa.array(np.bincount(place, weights=n).astype(np.int64)), pa.array(held.astype(np.int64))],
                    names=["lang", "source", "term", "n", "docs"],
                )

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, terms: Column, scale: int, prior: int) -> Column:
    """1 + floor(scale * (n + prior) / (total + prior * terms)) in whole numbers; null without terms."""
    wide = F.lit(scale).cast("decimal(12,0)") * (n + prior).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide, F.nullif(total + prior * terms, F.lit(0)).cast("decimal(20,0)"))


def joint_tables(rows: DataFrame) -> DataFrame:
    """How many terms have count ``m`` in source ``a`` and count ``n`` in source ``b``: one joint table per pair of groups.

    ``rows`` has ``lang``, ``block`` (all rows of a term are in one), ``term``, ``source``, ``n`` (above 0), ``p`` and
    ``zero`` (prices of the count and of 0 in that source, carried along).  A block is a 0/1 matrix with a row per term
    and a column per (source, count); its transpose times itself, strip by strip, counts the terms that two columns
    share.  Sums of ones are exact in 32-bit floats up to 2 ** 24 terms, far more than a block holds.  Columns
    come by rising count, and a product takes only the terms of its rarer strip.  ``a`` = ``b`` gives the margins; cells
    with a count of 0 follow from those.  Cells: ``lang``, ``a``, ``m``, ``pa``, ``za``, ``b``, ``n``, ``pb``, ``zb``, ``terms``.
    """

    def run(table: pa.Table) -> pa.Table:
        source = pc.dictionary_encode(table["source"].combine_chunks())
        names, code = source.dictionary, source.indices.to_numpy().astype(np.int64)
        term = pc.dictionary_encode(table["term"].combine_chunks()).indices.to_numpy().astype(np.int64)
        level, paid, free = (table[c].to_numpy() for c in ("n", "p", "zero"))
        order = np.lexsort((code, level))
        new = np.append(True, (level[order][1:] != level[order][:-1]) | (code[order][1:] != code[order][:-1]))
        heads = order[np.flatnonzero(new)]
        column = np.cumsum(new) - 1
        row = term[order]
        strips = [(lo, slice(*np.searchsorted(column, (lo, lo + STRIP)))) for lo in range(0, len(heads), STRIP)]
        place, cells = np.full(term.max() + 1, -1), []
        for k, (right_lo, right) in enumerate(strips):
            present = np.unique(row[right])
            place[:] = -1
            place[present] = np.arange(len(present))
            ones = np.zeros((len(present), STRIP), np.float32)
            ones[place[row[right]], column[right] - right_lo] = 1
            for left_lo, left in strips[: k + 1]:
                shared = np.flatnonzero(place[row[left]] >= 0)
                other = np.zeros((len(present), STRIP), np.float32)
                other[place[row[left]][shared], column[left][shared] - left_lo] = 1
                product = other.T @ ones
                x, y = np.nonzero(product)
                x, y, n = x + left_lo, y + right_lo, product[x, y].astype(np.int64)
                keep = x <= y
                cells.append((x[keep], y[keep], n[keep]))
        x, y, n = (np.concatenate([c[i] for c in cells]) for i in range(3))
        # codes differ from block to block; names give all blocks the same order of sources
        ranks = np.argsort(np.argsort(np.array(names.to_pylist(), object)))
        swap = ranks[code[heads[x]]] > ranks[code[heads[y]]]
        a, b = heads[np.where(swap, y, x)], heads[np.where(swap, x, y)]
        return pa.table({
            "lang": pa.array([table["lang"][0].as_py()] * len(n), pa.string()),
            "a": names.take(pa.array(code[a])), "m": level[a], "pa": paid[a], "za": free[a],
            "b": names.take(pa.array(code[b])), "n": level[b], "pb": paid[b], "zb": free[b], "terms": n,
        })

    schema = "lang string, a string, m long, pa long, za long, b string, n long, pb long, zb long, terms long"
    cells = rows.groupBy("lang", "block").applyInArrow(run, schema)
    return cells.groupBy("lang", "a", "m", "pa", "za", "b", "n", "pb", "zb").agg(F.sum("terms").alias("terms"))


def distance(x: str, y: str) -> Column:
    return F.abs(F.col(x) - F.col(y))


def pair_values(joint: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value``: sum of price differences over all kept terms, both ways round.

    Terms with a count above 0 in both sources are priced from the joint table; those of one source from its margin,
    as their other price is that of 0; the rest has the prices of 0 on both sides.
    """
    both = F.sum(F.col("terms") * (distance("pa", "pb") - distance("pa", "zb") - distance("za", "pb") + distance("za", "zb")))
    met = joint.where("a != b").groupBy("lang", "a", "b").agg(both.alias("met"))
    met = met.union(met.select("lang", "b", "a", "met"))
    margins = joint.where("a = b").select("lang", "a", "m", "pa", "terms")
    held = margins.groupBy("lang", "a").agg(F.sum("terms").alias("held"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"))
    alone = salted_join(margins, others, ["lang"], "inner", "m")
    alone = alone.groupBy("lang", "a", "b").agg(F.sum(F.col("terms") * distance("pa", "zb")).alias("alone"))
    sides = groups.select("lang", F.col("source").alias("a"), F.col("zero").alias("za"), "terms").join(held, ["lang", "a"], "left").na.fill(0, ["held"])
    right = sides.select("lang", F.col("a").alias("b"), F.col("za").alias("zb"), F.col("held").alias("held_b"))
    spine = salted_join(sides, right, ["lang"], "inner", "a").where("a != b")
    one_way = spine.join(alone, ["lang", "a", "b"], "left").join(alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("alone").alias("back")), ["lang", "a", "b"], "left")
    value = (
        F.coalesce("alone", F.lit(0)) + F.coalesce("back", F.lit(0)) + F.coalesce("met", F.lit(0))
        + F.coalesce((F.col("terms") - F.col("held") - F.col("held_b")) * distance("za", "zb"), F.lit(0))
    )
    return one_way.join(met, ["lang", "a", "b"], "left").select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value"))


def priced_terms(docs: DataFrame, least_docs: int, scale: int, prior: int, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms per group with their prices, and the groups with the price of a count of 0."""
    counts = store(count_terms(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("everywhere")).where(F.col("docs") >= least_docs).drop("docs")
    kept = store(kept, "kept-terms")
    rows = store(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("everywhere").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("_rows"))
    held = totals.groupBy("lang").agg(F.sum("_rows").alias("lang_rows"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left").join(held, "lang", "left")
    groups = groups.na.fill(0, ["terms", "lang_total", "total", "_rows", "lang_rows"])
    groups = store(groups.withColumn("zero", price(F.lit(0), F.col("total"), F.col("terms"), scale, prior)), "groups")
    known = groups.select("lang", "source", "terms", "lang_total", "total", "zero", "lang_rows")
    priced = salted_join(rows, known, ["lang", "source"], "inner", "term", groups.select("lang", "source", F.col("_rows").alias("_n")).where("_n > 0"))
    block = F.pmod(F.xxhash64("term"), F.floor(F.col("lang_rows") / per_block) + 1)
    priced = priced.select(
        "lang", "source", "term", "n", "zero", block.alias("block"), price(F.col("n"), F.col("total"), F.col("terms"), scale, prior).alias("p"),
        price(F.col("everywhere"), F.col("lang_total"), F.col("terms"), scale, prior).alias("q"),
    )
    return store(priced, "priced"), groups.select("lang", "source", "terms", "zero")


def audit_sources(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 30, scale: int = 10**9,
    prior: int = 5, top: int = 50, per_block: int = 1 << 14,
) -> DataFrame:
    """How far the sources of a language lie apart, and by which terms: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    A language keeps the terms in ``least_docs`` of its rows.  A group (lang, source) gives a kept term with ``n``
    occurrences the price 1 + floor(``scale`` (n + ``prior``) / (N + ``prior`` V)), N its occurrences of the V kept terms;
    so does the language as a whole.  Part ``pair`` names every other source of the language with the sum of price
    differences over all kept terms, part ``term`` the ``top`` terms that a group prices above its language.  All
    arithmetic is in whole numbers.  Ranks fall with the value, ties by item in order of UTF-8.

    Sums over terms are made from joint tables of counts, see ``joint_tables``.  Terms are dealt to blocks by hash, about
    ``per_block`` counts each, so a hot source or language has its counts in many.  Pairs of sources are the
    result itself, joined on the language.

    Null text, language and source count as empty.  Groups without terms have all their pairs; a language without
    kept terms has value 0 in them.  Rows that repeat are rows of their own.  Other columns are not read, so their
    names can't clash.  An empty table gives an empty result.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    rows, groups = priced_terms(docs, least_docs, scale, prior, per_block)
    joint = store(joint_tables(rows), "joint")
    group = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(joint, groups).withColumn("rank", F.row_number().over(group))
    terms = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(terms.withColumn("part", F.lit("term")).select(columns))


_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
v AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, v.term, COALESCE(c.n, 0) AS n FROM g JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM f),
l AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM l),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY 1, 2, 3),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(COALESCE(far.value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON y.lang = x.lang AND y.source <> x.source LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
