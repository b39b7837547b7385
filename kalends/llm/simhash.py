"""SimHash near-duplicates by BK-trees (operator 1)."""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm import bktree
from kalends.llm.common import shuffle_width, stored
from kalends.llm.components import component_labels

SEED, STEP = 42, 1 << 16
MOST_HASHES = 1 << 21  # of the shingle sets of one chunk of a shard
PIVOTS = 64  # members of a crowded shard that every chunk of it meets, on average
SPAN = 3  # width of a band of sizes, in powers of 1 / least
MARKS = 1 << 26  # bits of the table that tells which rows have to be looked at


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, repeats included; of the whole sequence if it is shorter; none without words."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    starts = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]
    ends = starts[np.minimum(np.arange(n) + shingle, len(words))] - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """64-bit fingerprint: a bit is 1 if it is set in over half the hashes; 0 without hashes."""
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), STEP):
        part = hashes[k : k + STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def _remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th of independent hashes made from given ones."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64))
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def _described(shingle: int, sketch: int, wide: int):
    """Arrow function: a text's fingerprint, its ``sketch`` smallest distinct shingle hashes and ``wide`` more fingerprint words.

    With a sketch, each shingle votes once, and the digest and the size of the shingle set come too.
    """

    def run(texts: pa.Array) -> pa.Array:
        prints, lows, more, nodes, sizes = [], [], [], [], []
        for text in texts:
            hashes = shingle_hashes(text.as_py() or "", shingle)
            if sketch:
                hashes = np.unique(hashes)
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(hashes))
                lows.append(hashes[:sketch].view(np.int64).tolist())
            prints.append(simhash(hashes))
            more.append([simhash(_remixed(hashes, k)) for k in range(1, wide + 1)])
        lows = lows if sketch else [[]] * len(prints)
        longs = pa.list_(pa.int64())
        arrays, names = [pa.array(prints, pa.int64()), pa.array(lows, longs), pa.array(more, longs)], ["fp", "low", "wide"]
        if sketch:
            arrays, names = [*arrays, pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64())], [*names, "node", "n"]
        return pa.StructArray.from_arrays(arrays, names)

    return F.arrow_udf(run, "fp long, low array<long>, wide array<long>" + (", node binary, n long" if sketch else ""))


def _shingle_set(shingle: int):
    """Arrow function: a text's distinct shingle hashes."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingle_hashes(text.as_py() or "", shingle)).view(np.int64) for text in texts], pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<long>")


def _block_keys(radius: int, blocks: int):
    """Shard keys that any two fingerprints within the radius share at least one of: the bits of ``blocks - radius`` blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)))


def _similar(label: np.ndarray, a: np.ndarray, b: np.ndarray, sets: tuple[np.ndarray, np.ndarray, np.ndarray], seen: np.ndarray, least: Fraction) -> None:
    """Join the classes of those pairs (a, b) whose sets have a Jaccard similarity of ``least`` or more; pairs of one class need no check.

    ``sets`` are the codes of all members, and where each one's begin and end; ``seen`` is all false, with a place for every code.
    """
    codes, begin, end = sets
    if not len(a):
        return
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    edges = np.r_[0, np.flatnonzero(np.diff(a)) + 1, len(a)]
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        x, y = a[i], b[i:j]
        y = y[label[y] != label[x]]
        own, size = end[x] - begin[x], end[y] - begin[y]
        fits = least.denominator * np.minimum(size, own) >= least.numerator * np.maximum(size, own)
        y, size = y[fits & (size > 0)], size[fits & (size > 0)]
        if not y.size:
            continue
        seen[codes[begin[x] : end[x]]] = True
        first = np.cumsum(size) - size
        both = np.add.reduceat(seen[codes[np.repeat(begin[y] - first, size) + np.arange(size.sum())]], first, dtype=np.int64)
        seen[codes[begin[x] : end[x]]] = False
        y = y[least.denominator * both >= least.numerator * (own + size - both)]
        bktree.merge(label, np.full(len(y), x), y)


def _tree_links(radius: int, more: tuple[str, ...] = (), limit: int = 0, least: Fraction | None = None):
    """Spanning links within the radius of every shard; rows come sorted by shard, shards may span Arrow batches.

    With ``least``, rows also have the fingerprint words ``more``, ``node`` and ``set``: every pair within the radius and ``limit`` bits
    of all words is checked by its sets before it links, and links are pairs of nodes.
    """
    columns = ("t", "key", "low", "high")
    exact = ("node", "set") if least is not None else ()

    def solve(part: dict[str, np.ndarray]):
        n = len(part["fp"])
        change = np.zeros(n, bool)
        change[0] = True
        for c in columns:
            change[1:] |= part[c][1:] != part[c][:-1]
        start = np.flatnonzero(change)[np.cumsum(change) - 1]
        keep = np.bincount(start, minlength=n)[start] > 1
        if not keep.any():
            return None
        prints, side = part["fp"][keep], part["side"][keep]
        words = [part[c][keep] for c in more]
        start = np.unique(start[keep], return_index=True)
        start = np.repeat(start[1], np.diff(np.r_[start[1], keep.sum()]))
        label = np.arange(len(prints))
        whole = part["low"][keep] == part["high"][keep]
        member = whole | (side == 0)  # side 0 of a split shard is the tree, side 1 is only searched
        spot = np.cumsum(member) - 1
        nodes = np.flatnonzero(member)
        first = np.full(len(prints), len(prints))
        np.minimum.at(first, start[nodes], nodes)
        head = first[start]
        asks = np.flatnonzero((head < len(prints)) & (whole | (side == 1)))
        root = spot[head[nodes]]
        tree = bktree.build(root, prints[nodes])
        if exact:
            own = part["set"][keep]
            size = np.array([len(x) for x in own])
            values, codes = np.unique(np.concatenate(list(own)), return_inverse=True)
            sets, seen = (codes, np.cumsum(size) - size, np.cumsum(size)), np.zeros(len(values), bool)
        for q, k in bktree.search(root, prints[nodes], tree, prints[asks], spot[head[asks]], radius):
            a, b = asks[q], nodes[k]
            if exact:
                gap = sum((np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in words), np.bitwise_count(prints[a] ^ prints[b]).astype(np.int64))
                near = (gap <= limit) & (~whole[a] | (a < b))  # members of a whole shard find each other twice
                _similar(label, a[near], b[near], sets, seen, least)
            else:
                bktree.merge(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(label)))
        if exact:
            names = part["node"][keep]
            return pa.RecordBatch.from_arrays([pa.array(names[linked], pa.binary()), pa.array(names[label[linked]], pa.binary())], ["a", "b"])
        return pa.RecordBatch.from_arrays([pa.array(prints[linked].view(np.int64)), pa.array(prints[label[linked]].view(np.int64))], ["a", "b"])

    def run(batches):
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*columns, "side", *exact)}
            part |= {c: batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", *more)}
            if rest is not None:
                part = {c: np.concatenate([rest[c], part[c]]) for c in part}
            if not len(part["fp"]):
                continue
            last = np.ones(len(part["fp"]), bool)
            for c in columns:
                last &= part[c] == part[c][-1]
            done = ~last
            if done.any() and (found := solve({c: v[done] for c, v in part.items()})) is not None:
                yield found
            rest = {c: v[last] for c, v in part.items()}
        if rest is not None and (found := solve(rest)) is not None:
            yield found

    return run


def _links(shards: DataFrame, radius: int, most: int) -> DataFrame:
    """Links of the shards ``(t, key, fp)``. A shard of over ``most`` is dealt into chunks, and each pair of chunks is one tree and its searches."""
    large = shards.groupBy("t", "key").count().where(F.col("count") > most)
    large = large.select("t", "key", F.ceil(F.col("count") / most).cast("int").alias("chunks"))
    return _tree_rows(shards.join(large, ["t", "key"], "left"), "fp").mapInArrow(_tree_links(radius), "a long, b long")


def _row_key(id_col: str, text_col: str):
    """128-bit digest of a row's id and text, both of which may be null."""
    own, text = F.col(id_col).cast("string"), F.col(text_col)
    lengths = (F.coalesce(F.octet_length(c), F.lit(-1)).cast("string") for c in (own, text))
    return F.unhex(F.md5(F.concat_ws(" ", *lengths, own, text).cast("binary")))


def _marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``marked``: true wherever ``row`` is among ``keys``, and by chance where it shares its bit with one of them.

    The bits are a table of fixed size, which is broadcast, so rows stay where they are. Where it is crowded, more are marked.
    """
    place = F.pmod(F.xxhash64("row"), F.lit(MARKS))
    cells = keys.select(F.bitmap_bucket_number(place).alias("cell"), F.bitmap_bit_position(place).alias("bit"))
    cells = cells.repartition(shuffle_width(rows.sparkSession), "cell").groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits"))
    found = rows.withColumn("cell", F.bitmap_bucket_number(place)).join(F.broadcast(cells), "cell", "left")
    bit = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, bit.bitwiseAND(7)) == 1, F.lit(False))
    return found.withColumn("marked", marked).drop("cell", "bits")


def _exact_links(shards: DataFrame, base: DataFrame, texts: DataFrame, shingle: int, radius: int, most: int, limit: int, least: float) -> DataFrame:
    """Links of nodes whose shingle sets have a Jaccard similarity of ``least`` or more, among the pairs that a shard's tree finds.

    ``shards`` has ``(t, key, fp, node, n)`` and further fingerprint words, ``base`` rows ``(node, row)``, ``texts`` rows ``(row, text)``. Sets
    are made only for members of shards of two or more, of one row each, where the texts are; no text is shuffled. A shard of
    over ``most`` members or ``MOST_HASHES`` hashes is crowded: its members are parted by size (``_sized``) and dealt into chunks. First each chunk is searched by itself, together with a few pivots that all
    chunks of a shard meet, so that near copies find one class whatever their number. Then members outside a shard's largest class
    meet all others (``_rest``): pairs within that class need no look. Rows grow with the members, and with members times those
    outside the largest class over ``most``.
    """
    more = tuple(c for c in shards.columns if c not in ("t", "key", "fp", "node", "n"))
    shards = stored(shards, "shards")
    dealt = stored(shards.join(_chunked(shards, most), ["t", "key"]), "shards")
    crowded = dealt.where("chunks > 1").drop("chunks", "count")
    some = bool(crowded.take(1))
    if some:
        crowded = stored(_sized(crowded, least), "crowded")
        crowded = stored(crowded.join(_chunked(crowded, most), ["t", "key"]), "crowded")
        dealt = dealt.where("chunks = 1").unionByName(crowded)
    nodes = stored(dealt.select("node").distinct().join(base.groupBy("node").agg(F.min("row").alias("row")), "node"), "nodes")

    def solved(rows: DataFrame, nodes: DataFrame) -> DataFrame:
        # rows that repeat a text and its id are put together before the shuffle, which serves the join too
        found = _marked(texts, nodes.select("row")).where("marked").select("row", _shingle_set(shingle)(F.col("text")).alias("set"))
        sets = found.groupBy("row").agg(F.first("set").alias("set"))
        rows = rows.drop("n", "chunks", "count").join(nodes, "node").join(sets, "row")
        rows = rows.repartition(shuffle_width(rows.sparkSession), "t", "key", "low", "high").sortWithinPartitions("t", "key", "low", "high", "side", "node")
        rows = rows.select("t", "key", "low", "high", "side", "fp", *more, "node", "set")
        return rows.mapInArrow(_tree_links(radius, more, limit, Fraction(str(least))), "a binary, b binary")

    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    pivot = F.pmod(F.xxhash64("node", F.lit(1)), F.col("count")) < PIVOTS
    chunk = F.when(pivot, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(own))
    links = solved(dealt.withColumn("low", F.explode(chunk)).withColumn("high", F.col("low")).withColumn("side", F.lit(0)), nodes)
    if not some:
        return links
    labels = stored(component_labels(stored(links, "links")), "labels")
    rest = stored(_rest(crowded.where("chunks > 1"), labels, most), "rest")
    nodes = stored(nodes.join(rest.select("node").distinct(), "node", "left_semi"), "nodes")
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(solved(_met(rest), nodes))


def _chunked(shards: DataFrame, most: int) -> DataFrame:
    """Shards of two or more members, with their ``count`` and the number of ``chunks`` that hold them."""
    several = shards.groupBy("t", "key").agg(F.count("*").alias("count"), F.sum("n").alias("n")).where("count > 1")
    return stored(several.select("t", "key", "count", _chunks(F.col("count"), F.col("n"), most).alias("chunks")), "several")


def _chunks(count, n, most: int):
    return F.ceil(F.greatest(count / most, n / MOST_HASHES)).cast("int")


def _sized(shards: DataFrame, least: float) -> DataFrame:
    """Shards parted by set size into bands, ``t``, that overlap: sets whose sizes allow a similarity of ``least`` share one.

    With x the logarithm of the size to the base ``1 / least``, such sets differ by 1 at most in x. Band k holds x from ``k * SPAN``
    to ``(k + 1) * SPAN + 1``.
    """
    x = F.log("n") / -np.log(least)
    band = F.floor(x / SPAN).cast("int")
    return shards.withColumn("t", F.explode(F.when(x - band * SPAN <= 1 + 1e-6, F.array(band, band - 1)).otherwise(F.array(band))))


def _rest(crowded: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Shards with members outside their largest class, and the ``chunk`` of each member.

    The class's members are dealt into chunks from 0, the others into the ``others`` chunks that follow, from ``first``.
    """
    rows = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = stored(rows.groupBy("t", "key", "label").agg(F.count("*").alias("c"), F.sum("n").alias("h")), "sizes")
    bulk = F.max_by("label", F.struct("c", "label")).alias("bulk")
    shards = sizes.groupBy("t", "key").agg(bulk, F.max("c").alias("c"), F.max_by("h", F.struct("c", "label")).alias("h"), F.sum("c").alias("all_c"), F.sum("h").alias("all_h"))
    others = _chunks(F.col("all_c") - F.col("c"), F.col("all_h") - F.col("h"), most)
    shards = shards.where("all_c > c").select("t", "key", "bulk", _chunks(F.col("c"), F.col("h"), most).alias("first"), others.alias("others"))
    rows = rows.join(shards, ["t", "key"])
    inside, place = F.col("label") == F.col("bulk"), F.xxhash64("node")
    rows = rows.withColumn("chunk", F.when(inside, F.pmod(place, "first")).otherwise(F.col("first") + F.pmod(place, "others")).cast("int"))
    return rows.drop("label", "bulk")


def _met(rest: DataFrame) -> DataFrame:
    """Pairs of chunks in which members outside a shard's largest class meet all of its members."""
    least = F.when(F.col("chunk") < F.col("first"), F.col("first")).otherwise(0)
    rows = rest.withColumn("other", F.explode(F.sequence(least, F.col("first") + F.col("others") - 1)))
    rows = rows.withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    return rows.withColumn("side", (F.col("chunk") > F.col("other")).cast("int")).drop("first", "others", "chunk", "other")


def _tree_rows(dealt: DataFrame, node: str) -> DataFrame:
    """Shards with their numbers of ``chunks`` (null is one) dealt to tasks: for each pair of chunks, a side to build from and one to search."""
    names = [c for c in dealt.columns if c not in ("t", "key", "fp", "chunks")]
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64(node), F.coalesce("chunks", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    rows = dealt.select(
        "t", "key", "fp", *names, F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        (F.col("chunk") > F.col("other")).cast("int").alias("side"),
    )
    return rows.repartition(shuffle_width(dealt.sparkSession), "t", "key", "low", "high").sortWithinPartitions("t", "key", "low", "high", "side", node)


def _classes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, blocks: int, sketch: int, most: int, others: tuple[str, ...], wide: int, limit: int, least: float,
    rows: bool = False,
) -> tuple[DataFrame, DataFrame, str]:
    """Rows (doc_id, _others, fp), for each fingerprint its smallest id, its class's smallest id and its class's smallest linked fingerprint, and the
    column that tells texts apart: ``fp``, or with a sketch the digest of the shingle set, ``node``, in place of the fingerprint. With a sketch, or with
    ``rows``, they also have the key of their id and text, ``row``, by which ``docs`` is read again: texts are not stored a second time."""
    described = _described(shingle, sketch, wide)(F.col("text"))
    base = docs.select(F.col(id_col).alias("doc_id"), *(F.col(c).alias(f"_{c}") for c in others), F.col(text_col).alias("text"))
    kept, node = [f"_{c}" for c in others], "node" if sketch else "fp"
    if sketch or rows:
        base, kept = base.withColumn("row", _row_key("doc_id", "text")), [*kept, "row"]
    base = base.select("doc_id", *kept, described.alias("d"))
    base = stored(base.select("doc_id", *kept, *(("d.fp", "d.low", "d.wide", "d.node", "d.n") if sketch else ("d.fp",))), "prints")
    smallest = base.groupBy(node).agg(F.min("doc_id").alias("first_id"))
    if sketch:
        more = [F.get("wide", F.lit(k)).alias(f"w{k}") for k in range(wide)]
        shards = base.select(F.lit(0).alias("t"), F.explode("low").alias("key"), "fp", *more, "node", "n").distinct()
        texts = docs.select(_row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
        links = _exact_links(shards, base.select("node", "row"), texts, shingle, radius, most, limit, least)
    else:
        shards = smallest.select("fp", F.explode(_block_keys(radius, blocks)).alias("k")).select("k.t", "k.key", "fp")
        links = _links(shards, radius, most)
    labels = component_labels(links).withColumnRenamed("node", "member")
    named = labels.join(smallest, labels["member"] == smallest[node]).select(node, "label", "first_id")
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = named.join(names, "label").select(node, "label", "component_id")
    classes = smallest.join(linked, node, "left").select(
        node, "first_id", F.coalesce("label", node).alias("label"), F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # written, so that a join with the rows shuffles both sides and adaptive execution can split a text that many rows share
    return base, stored(classes, "classes"), node


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, radius: int = 3, blocks: int = 5, sketch: int = 0, most: int = 4096,
    others: tuple[str, ...] = (), wide: int = 0, limit: int = 0, least: float = 0.8,
) -> DataFrame:
    """Class of every document whose SimHash fingerprints link at ``radius`` or fewer differing bits.

    Returns ``doc_id``, ``others`` as they are, ``fingerprint`` (long) and ``component_id``, one row per row of ``docs``. Distinct fingerprints
    are dealt into shards, each shard gets a BK-tree, and each member searches its shard's tree; only a spanning
    forest of the links leaves a shard, so output and memory stay linear in its members.

    Shards: with ``sketch`` 0, every choice of ``blocks - radius`` of the ``blocks`` bit blocks, which loses no pair
    within the radius. For wide radii bit blocks select nothing; ``sketch`` k deals fingerprints by the k smallest
    shingle hashes of their texts instead, of which near copies share one except with a chance of about
    ``(1 - similarity) ** k``. There, ``wide`` more fingerprint words of 64 bits each tell similarities apart better, and
    fingerprints only find candidates, within the radius and in at most ``limit`` bits of all words: each shingle votes once,
    texts are told apart by their shingle sets, and a candidate pair links if the Jaccard similarity of its sets is ``least``
    or more, counted in the shard's task.

    Null or wordless texts have fingerprint 0 and link like any other; with a sketch they are copies of one another.
    Rows with a null id get a class, but give it no
    name; a class without any id has a null ``component_id``. Repeated ids and rows stay as they are. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    base, classes, node = _classes(docs, id_col, text_col, shingle, radius, blocks, sketch, most, others, wide, limit, least)
    rows = base.join(classes.select(node, "component_id"), node)
    return rows.select("doc_id", *(F.col(f"_{c}").alias(c) for c in others), F.col("fp").alias("fingerprint"), "component_id")


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, radius: int = 3, blocks: int = 5, sketch: int = 0, most: int = 4096,
    others: tuple[str, ...] = (), wide: int = 0, limit: int = 0, least: float = 0.8,
) -> DataFrame:
    """One document of each class of ``near_duplicates``: ``doc_id`` and ``others``.

    The row with the class's smallest id stays; of rows that repeat it one, of texts that share it that with the smallest
    fingerprint (with a sketch, digest of its shingles), of a class without ids one row of the smallest. The choice is made by ids and digests;
    then ``docs`` is read again, and only rows that go or repeat one another (``_marked``) are shuffled. So ``docs`` must read the same each time.
    """
    base, classes, node = _classes(docs, id_col, text_col, shingle, radius, blocks, sketch, most, (), wide, limit, least, rows=True)
    chosen = classes.where("first_id <=> component_id").groupBy("label", "first_id").agg(F.min(node).alias(node))
    kept = base.join(chosen.select(node, "first_id"), (base[node] == chosen[node]) & base["doc_id"].eqNullSafe(chosen["first_id"]), "left_semi")
    kept = kept.groupBy(node, "doc_id").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("kept"))
    held = stored(base.groupBy("row").agg(F.count("*").alias("count")).join(kept, "row", "left"), "held")
    found = _marked(docs.select(_row_key(id_col, text_col).alias("row"), F.col(id_col).alias("doc_id"), *others), held.where("kept is null or count > 1"))
    asked = found.where("marked").dropDuplicates(["row"]).join(held.where("kept"), "row", "left_semi")
    return found.where("not marked").unionByName(asked).select("doc_id", *others)
