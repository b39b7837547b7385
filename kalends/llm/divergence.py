"""Divergence of the sources of each language: a quadtree over the group-term count matrix (operator 12)."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import stored

#: Letters A to Z in lower case, every other ASCII character a space; bytes of other characters stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PART = 4 << 20  # bytes of a text that are cut into terms at once, up to the next space
HELD = 400_000  # counts that a task holds before it passes them on
ROWS, COLUMNS = 128, 4096  # groups and terms of a tile
LEAF = 4  # leaves are 2 ** LEAF groups by as many terms


def _terms(text: bytes):
    """Terms of a text, for some megabytes at a time; a term is never cut."""
    start = 0
    while start < len(text):
        end = start + PART
        piece = text[start:end].translate(TERM_BYTES)
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            more = text[end : end + PART].translate(TERM_BYTES)
            stop = more.find(b" ")
            piece, end = piece + (more if stop < 0 else more[:stop]), end + (len(more) if stop < 0 else stop)
        yield piece.split()
        start = end


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])


def _count(batches):
    """Occurrences and documents of each term in a task's rows, by group; a group also gets one row without a term."""

    def passed_on():
        for (lang, source), (times, rows) in held.items():
            names = [None, *times]
            for k in range(0, len(names), 100_000):
                part = names[k : k + 100_000]
                size = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(lang, pa.string()), size), pa.repeat(pa.scalar(source, pa.string()), size),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([times.get(t, 0) for t in part], pa.int64()),
                    pa.array([rows.get(t, 0) for t in part], pa.int64()),
                ], schema=COUNTS)
        held.clear()

    held, size = defaultdict(lambda: (Counter(), Counter())), 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.large_binary())
        for k in range(batch.num_rows):
            times, rows = held[langs[k], sources[k]]
            before, seen = len(times), None
            for words in _terms(texts[k].as_py()):
                times.update(words)
                new = set(words)
                rows.update(new if seen is None else new - seen)
                seen = new if seen is None else seen | new
            size += 1 + len(times) - before
            if size > HELD:
                yield from passed_on()
                size = 0
    yield from passed_on()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``df`` (documents), and a row with a null term for every group."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).alias("text"))
    partial = rows.mapInArrow(_count, "lang string, source string, term string, n long, df long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


# --- the quadtree

class QuadTree:
    """Which quadrants of a count matrix hold anything, level by level, and its lowest quadrants with their prices.

    ``row`` and ``column`` are the places of the nonzero cells, ``price`` their prices and ``zero`` the price of a zero cell in
    each row. Level 0 is the whole matrix, a square of ``2 ** height`` leaves; a quadrant that is absent is all zero.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, price: np.ndarray, zero: np.ndarray, height: int):
        self.rows, self.zero = len(zero), zero
        self.levels = [np.unique(((row >> LEAF + s) << 32) | (column >> LEAF + s)) for s in range(height, -1, -1)]
        side, leaves = 1 << LEAF, self.levels[-1]
        self.padded = np.r_[zero, np.zeros(-len(zero) % side, np.int64)].reshape(-1, side)
        self.leaves = np.repeat(self.padded[leaves >> 32][:, :, None], side, axis=2)
        place = np.searchsorted(leaves, ((row >> LEAF) << 32) | (column >> LEAF))
        self.leaves[place, row & side - 1, column & side - 1] = price

    def holds(self, level: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Whether the quadrants at these places are there."""
        known, code = self.levels[level], (row << 32) | column
        if not len(known):
            return np.zeros(len(code), bool)
        return known[np.minimum(np.searchsorted(known, code), len(known) - 1)] == code

    def blocks(self, row: int, column: np.ndarray) -> np.ndarray:
        """Prices of the leaves of one row of quadrants at these columns; an all-zero one has its rows' price of zero throughout."""
        out = np.repeat(np.repeat(self.padded[row][None, :, None], len(column), axis=0), 1 << LEAF, axis=2)
        code = (row << 32) | column
        there = self.holds(len(self.levels) - 1, np.full(len(column), row), column)
        out[there] = self.leaves[np.searchsorted(self.levels[-1], code[there])]
        return out


def distances(left: QuadTree, right: QuadTree, columns: int) -> np.ndarray:
    """Sum of the absolute price differences over ``columns`` terms, for each row of ``left`` with each of ``right``.

    Both trees are descended together: from a pair of row ranges over one column range to the pairs of their halves, as long
    as either side holds anything there. Pairs of leaves are compared cell by cell; over all other terms both rows are zero,
    which costs the difference of their prices of zero times the number of those terms.
    """
    one, two, at = (np.zeros(1, np.int64) for _ in range(3))
    height = len(left.levels) - 1
    for level in range(1, height + 1):
        half = np.arange(8)
        one, two, at = ((2 * x[:, None] + (half >> s & 1)).ravel() for x, s in ((one, 2), (two, 1), (at, 0)))
        inside = (one << LEAF + height - level < left.rows) & (two << LEAF + height - level < right.rows)
        one, two, at = one[inside], two[inside], at[inside]
        some = left.holds(level, one, at) | right.holds(level, two, at)
        one, two, at = one[some], two[some], at[some]
    if not height:
        some = left.holds(0, one, at) | right.holds(0, two, at)
        one, two, at = one[some], two[some], at[some]
    side = 1 << LEAF
    total = np.abs(left.zero[:, None] - right.zero[None, :]) * columns
    order = np.lexsort((two, one))
    one, two, at = one[order], two[order], at[order]
    edges = np.flatnonzero(np.r_[True, (np.diff(one) != 0) | (np.diff(two) != 0), True]) if len(one) else [0]
    for i, j in zip(edges, edges[1:]):
        a, b = int(one[i]), int(two[i])
        rows = slice(a * side, min((a + 1) * side, left.rows)), slice(b * side, min((b + 1) * side, right.rows))
        na, nb = rows[0].stop - rows[0].start, rows[1].stop - rows[1].start
        differ = np.zeros((na, nb), np.int64)
        for k in range(i, j, 256):
            x, y = left.blocks(a, at[k : min(k + 256, j)])[:, :na], right.blocks(b, at[k : min(k + 256, j)])[:, :nb]
            for r in range(na):
                differ[r] += np.abs(x[:, r, None, :] - y).sum(axis=(0, 2))
        # a leaf at the edge has cells beyond the last term; both rows are zero there, so they cancel out
        total[rows] += differ - np.abs(left.zero[rows[0], None] - right.zero[None, rows[1]]) * side * (j - i)
    return total


TILE = pa.schema([("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _tile(most: int):
    """Function of one tile: partial sums of its group pairs, and the ``most`` largest terms of each group against its language."""

    def run(key, table):
        lang, low, high = key[0].as_py(), key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        names = pc.unique(table["term"].drop_null())
        column = pc.index_in(table["term"], names).to_numpy(zero_copy_only=False)
        side, price, zero, q = (table[c].to_numpy(zero_copy_only=False) for c in ("side", "p", "zero", "q"))
        empty = table["term"].is_null().to_numpy(zero_copy_only=False)
        height = max(int(max(len(names), ROWS) - 1).bit_length() - LEAF, 0)
        trees, sources, spans = {}, {}, {}
        for s in (0, 1):
            mine = side == s
            marks = np.flatnonzero(mine & empty)
            cells = np.flatnonzero(mine & ~empty)
            sources[s] = table["source"].take(pa.array(marks)).combine_chunks()
            row = pc.index_in(table["source"].take(pa.array(cells)), sources[s]).to_numpy(zero_copy_only=False).astype(np.int64)
            need = max(height, int(max(len(marks), 1) - 1).bit_length() - LEAF)
            spans[s] = (row, column[cells].astype(np.int64), price[cells], zero[marks].astype(np.int64), cells)
            height = max(height, need)
        for s in (0, 1):
            trees[s] = QuadTree(*spans[s][:4], height)
        out = []
        # the first band prices zero against zero for all terms of the language, the others only what differs from that
        total = distances(trees[0], trees[0 if low == high else 1], int(q[empty].max()))
        one, two = np.triu_indices(len(sources[0]), 1) if low == high else np.indices(total.shape).reshape(2, -1)
        take = lambda s, k: sources[s].take(pa.array(k))
        out.append((take(0, one), take(0 if low == high else 1, two), total[one, two], "pair"))
        if low == high:
            row, columns, prices, _, cells = spans[0]
            value = prices - q[cells]
            rank = np.empty(len(names), np.int64)
            rank[pc.sort_indices(names).to_numpy(zero_copy_only=False)] = np.arange(len(names))
            above = np.flatnonzero(value > 0)
            above = above[np.lexsort((rank[columns[above]], -value[above], row[above]))]
            place = np.arange(len(above)) - np.searchsorted(row[above], row[above])
            above = above[place < most]
            out.append((take(0, row[above]), names.take(pa.array(columns[above])), value[above], "term"))
        return pa.concat_tables([
            pa.Table.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(v)), pa.repeat(pa.scalar(part, pa.string()), len(v)), a.cast(pa.string()), b.cast(pa.string()), pa.array(v, pa.int64())], schema=TILE)
            for a, b, v, part in out
        ])

    return run


def divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *, least: int = 30, most: int = 50, add: int = 5, scale: int = 1_000_000_000,
    rows: int = ROWS, columns: int = COLUMNS,
) -> DataFrame:
    """How far the sources of a language lie from each other, and by which terms each leaves its language.

    Terms are runs of letters and of characters beyond ASCII, A to Z in lower case. A language keeps the terms of at least
    ``least`` of its documents. A group (language and source) and the whole language price a kept term of count ``n`` at
    ``1 + floor(scale * (n + add) / (N + add * V))``, with N their occurrences of the V kept terms. Returns ``lang``, ``source``,
    ``part``, ``item``, ``value`` and ``rank``: for ``pair`` every other source of the language and the sum over all kept terms
    of the absolute differences, for ``term`` the ``most`` terms priced furthest above the language's price among those that
    occur in the group. Ranks go by value, descending, then item.

    Groups and terms are dealt by hash into tiles of about ``rows`` by ``columns``; a tile of two row blocks is compared by a
    joint descent of two quadtrees. All arithmetic is exact. Null text, language and source are empty strings; a group without
    terms has a row of zeros; a language without kept terms has distances of 0; repeated rows are documents of their own; other
    columns are not read; an empty table gives none.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "terms")
    term = Window.partitionBy("lang", "term")
    cells = counts.where("term is not null").withColumns({
        "documents": F.sum("df").over(term), "total": F.sum("n").over(term), "first": F.min("source").over(term) == F.col("source"),
    })
    cells = stored(cells.where(F.col("documents") >= least).select("lang", "source", "term", "n", "total", "first"), "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("first").alias("terms"))
    groups = counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left")
    groups = stored(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "terms"))), "groups")
    langs = groups.groupBy("lang").agg(F.sum("terms").alias("v"), F.sum("size").alias("n_lang"), F.count("*").alias("s"))
    groups = groups.drop("terms").join(langs, "lang")

    def price(n: str, over: str) -> str:
        return f"cast(1 + (cast({scale} as decimal(18,0)) * cast({n} + {add} as decimal(20,0))) div cast({over} as decimal(20,0)) as long)"

    groups = groups.withColumn("over", F.col("size") + add * F.col("v")).withColumn("over_lang", F.col("n_lang") + add * F.col("v")).withColumns({
        "zero": F.expr(f"case when v > 0 then {price('0', 'over')} else 0L end"),
        "bands": F.greatest(F.lit(1), F.ceil(F.col("v") / columns)).cast("long"), "blocks": F.greatest(F.lit(1), F.ceil(F.col("s") / rows)).cast("long"),
    })
    groups = groups.withColumn("own", F.pmod(F.xxhash64(F.lit(1), "source"), "blocks"))
    groups = stored(groups.select("lang", "source", "over", "over_lang", "v", "zero", "bands", "blocks", "own"), "groups")
    nonzero = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", F.expr(price("n", "over")).alias("p"), "zero", F.expr(price("total", "over_lang")).alias("q"), "own", "blocks",
        F.pmod(F.xxhash64("term"), "bands").alias("band"),
    )
    marks = groups.withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "zero",
        F.when(F.col("band") == 0, F.col("v")).otherwise(0).cast("long").alias("q"), "own", "blocks", "band",
    )
    tiles = nonzero.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "band", (F.col("own") > F.col("other")).cast("int").alias("side"),
        "source", "term", "p", "zero", "q",
    )
    found = tiles.groupBy("lang", "low", "high", "band").applyInArrow(_tile(most), "lang string, part string, source string, item string, value long")
    found = stored(found, "tiles")
    pairs = found.where("part = 'pair'").groupBy("lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b")).agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pairs = pairs.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= most))
