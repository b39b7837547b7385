"""SimHash document fingerprints and their search by permuted block tables (operator 8, DataFrame functions only)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import shuffle_width, stored

#: One bit in each half of a long: two votes are counted in one sum.
LANES = (1 << 32) + 1
PAIR_WEIGHT, WORD_WEIGHT = 2, 1


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits that two fingerprints have in common."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def _voted(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint ``fp`` of the column ``text`` for each row of unique ``keys``.

    Every word votes with two hashes: its own and that of the pair it forms with the word before it. Votes are counted by
    32 sums of two bits each, before the shuffle; so a text's words never travel. A bit is set if it has over half of the
    weight; a text without words gets 0.
    """
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    rows = texts.select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("own"))
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("own", 1, F.greatest(F.size("own") - 1, F.lit(0))))
    rows = rows.select(*keys, F.explode_outer(F.arrays_zip(F.col("own"), before.alias("before"))).alias("w"))
    rows = rows.select(*keys, F.col("w.own").alias("own"), F.when(F.col("w.own").isNotNull(), F.xxhash64("w.before", "w.own")).alias("pair"))
    lanes = F.lit(LANES).cast("long")
    votes = [F.sum(F.shiftrightunsigned("pair", k).bitwiseAND(lanes) * PAIR_WEIGHT + F.shiftrightunsigned("own", k).bitwiseAND(lanes) * WORD_WEIGHT).alias(f"v{k}") for k in range(32)]
    sums = rows.groupBy(*keys).agg(*votes, F.count("own").alias("n"))
    weight, low = F.col("n") * (PAIR_WEIGHT + WORD_WEIGHT), F.lit((1 << 32) - 1).cast("long")
    bits = F.lit(0).cast("long")
    for k in range(32):
        for at, lane in ((k, F.col(f"v{k}").bitwiseAND(low)), (k + 32, F.shiftrightunsigned(f"v{k}", 32))):
            one = (1 << at) - (1 << 64 if at == 63 else 0)
            bits = bits.bitwiseOR(F.when(lane * 2 > weight, F.lit(one)).otherwise(F.lit(0)).cast("long"))
    return sums.select(*keys, bits.alias("fp"))


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text and its edited one: the last quarter of its code points replaced by as many first ones of the next document.

    Next is the following id, nulls first, ties in order of a hash of the text; the first document follows the last. Ranges
    of ids, cut at approximate quantiles, are sorted on their own, so texts are shuffled once; a range also gets a copy of
    the documents that begin the one after it. Returns ``row`` and ``next_row`` (numbers of rows), ``doc_id``, ``n_chars``,
    ``text`` and ``edited``, one row per row of ``docs``. Ids must be numbers.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    ranges = 3 * shuffle_width(spark)
    cuts = docs.agg(F.percentile_approx(id_col, [k / ranges for k in range(1, ranges)], 20 * ranges).alias("cuts"), F.min(id_col).alias("least"), F.count_if(F.col(id_col).isNull()).alias("nulls")).first()
    starts = sorted({c for c in cuts["cuts"] or [] if c > cuts["least"] or cuts["nulls"]})
    kind = docs.schema[id_col].dataType
    known = F.array(*(F.lit(s).cast(kind) for s in starts)).cast(f"array<{kind.simpleString()}>")
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(known, lambda s: s <= F.col("doc_id"))))
    begins = F.coalesce(F.array_contains(known, F.col("doc_id")), F.lit(False))
    first = F.col("doc_id").isNull() if cuts["nulls"] else F.col("doc_id").eqNullSafe(F.lit(cuts["least"]))
    place = lambda bucket, ahead: F.struct(bucket.cast("int").alias("bucket"), F.lit(ahead).alias("ahead"))
    none = F.lit(None).cast("struct<bucket:int,ahead:int>")
    places = F.array_compact(F.array(
        place(own, 0), F.when(begins & ~first, place(own - 1, 1)).otherwise(none), F.when(first, place(F.lit(len(starts)), 1)).otherwise(none),
    ))
    dealt = base.withColumn("place", F.explode(places)).select("doc_id", "text", "row", "place.bucket", "place.ahead")
    order = Window.partitionBy("bucket").orderBy("ahead", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "row")
    dealt = dealt.withColumns({"next_text": F.lead("text").over(order), "next_row": F.lead("row").over(order)}).where("ahead = 0")
    size = F.char_length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - quarter), F.substring("next_text", F.lit(1), quarter))
    return dealt.select("row", "next_row", "doc_id", size.cast("long").alias("n_chars"), "text", edited.alias("edited"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """All fingerprints of ``prints`` within ``radius`` bits of those of ``queries``, without the query's own value.

    Both have ``fp``; each distinct value is looked up once. A table for every choice of ``blocks - radius`` of the blocks is keyed
    by their bits: two fingerprints within the radius agree in at least one choice. The join's condition keeps pairs
    within the radius only, in the first table where they agree. Returns ``query``, ``fp`` and ``distance``.
    """
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)))
        return df.where("fp is not null").select("fp").distinct().select(F.col("fp").alias(name), F.explode(keys).alias("k")).select(name, "k.t", "k.key")

    apart = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*(F.when(apart.bitwiseAND(F.lit(m)) == 0, k) for k, m in enumerate(masks)))
    left, right = tables(queries, "query"), tables(prints, "fp")
    near = (left["t"] == right["t"]) & (left["key"] == right["key"]) & (F.bit_count(apart) <= radius) & (F.col("query") != F.col("fp")) & (first == left["t"])
    return left.join(right, near).select("query", "fp", F.bit_count(apart).alias("distance"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how like they and the next document's are.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fp``, ``edited_fp``, ``near_edited`` and ``near_next``, one row per row
    of ``docs``; null texts count as empty, equal texts have equal fingerprints, other columns are not read, and an empty
    table gives an empty result.
    """
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))
    rows = edited_texts(docs, id_col, text_col).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["row", "next_row", "doc_id", "n_chars", "edited_sha256"]
    voted = _voted(rows.select(*keys, F.explode(both).alias("b")).select(*keys, "b.which", "b.text"), [*keys, "which"])
    one = lambda k: F.max(F.when(F.col("which") == k, F.col("fp")))
    prints = stored(voted.groupBy(*keys).agg(one(0).alias("fp"), one(1).alias("edited_fp")), "prints")
    after = prints.select(F.col("row").alias("next_row"), F.col("fp").alias("next_fp"))
    return prints.join(after, "next_row").select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
