"""Chat formatting of reply trees (operator 6, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of chat templates begin with < or [ and go on with one of these; a backslash put between breaks them.
TAILS = r"\||/?s>|/?INST\]|/?SYS>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Break every control string by one backslash after its first character; a broken one gets one more."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({TAILS})", "$1$2$3")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def reply_paths(nodes: DataFrame) -> DataFrame:
    """Every root-to-leaf path of the reply trees ``nodes`` (key, node, parent): rows (key, leaf, node, back).

    ``back`` counts the steps from the leaf. A round joins the table of ancestors 2^k steps up with itself and appends those
    ancestors to the paths, so the rounds grow with the logarithm of the depth. A parent that is missing makes its child
    a root; a cycle raises ``ValueError``.
    """
    tree = nodes.select("key", "node", "parent").distinct()
    ids = tree.select("key", F.col("node").alias("parent")).distinct()
    jumps = stored(tree.join(ids, ["key", "parent"]).select("key", "node", F.col("parent").alias("up")), "jumps")
    inner = jumps.select("key", F.col("up").alias("node")).distinct()
    leaves = ids.withColumnRenamed("parent", "node").join(inner, ["key", "node"], "left_anti")
    paths = leaves.select("key", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    step, size = 1, None
    while not jumps.isEmpty():
        size = tree.count() if size is None else size
        if step > size:
            raise ValueError("the replies form a cycle")
        further = paths.join(jumps, ["key", "node"]).select("key", "leaf", F.col("up").alias("node"), (F.col("back") + step).alias("back"))
        paths = stored(paths.unionByName(further), "paths")
        longer = jumps.select("key", F.col("node").alias("from"), F.col("up").alias("node")).join(jumps, ["key", "node"])
        jumps, step = stored(longer.select("key", F.col("from").alias("node"), "up"), "jumps"), 2 * step
    return paths


def format_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """Format the best reply paths of every tree as one conversation each.

    ``nodes`` has ``conv_id``, ``node`` and ``parent`` (one orderable type), ``role``, ``text`` and ``score``. A path's score is the sum of its
    nodes' (null counts 0); the ``branches`` best of a tree are kept, ties to the smaller leaf, all of them by default.
    Every turn becomes start mark, escaped role, line feed, escaped text, end mark and line feed; ``loss`` holds the (start,
    length) in code points, from 1, of each assistant text. Null roles and texts count as empty, a null ``conv_id`` is a tree of its
    own, repeated node ids are turns one after the other in order of role and text. Other columns are not read.

    Returns ``conv_id``, ``leaf``, ``score``, ``formatted`` and ``loss``. A row is one conversation, so a path must fit in memory.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    base = nodes.select(key.alias("key"), "conv_id", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    paths = reply_paths(base)
    if branches is not None:
        scored = paths.join(base.select("key", "node", "score"), ["key", "node"]).groupBy("key", "leaf").agg(F.sum("score").alias("total"))
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("total"), "leaf"))
        paths = paths.join(scored.withColumn("rank", rank).where(F.col("rank") <= branches).select("key", "leaf"), ["key", "leaf"], "left_semi")
    piece = F.struct((-F.col("back")).alias("place"), _escape_role(F.col("role")).alias("role"), escape(F.col("text")).alias("text"), (F.col("role") == LOSS_ROLE).alias("loss"))
    turns = paths.join(base.drop("parent"), ["key", "node"]).groupBy("key", "leaf")
    turns = turns.agg(F.first("conv_id").alias("conv_id"), F.sum("score").alias("score"), F.sort_array(F.collect_list(piece)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")

    def next_turn(a: Column, t: Column) -> Column:
        begin = a["at"] + len(START) + 1 + F.char_length(t["role"])
        size = F.char_length(t["text"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(END) + 1).alias("at"), F.when(t["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    loss = F.aggregate("turns", F.struct(F.lit(1).alias("at"), none.alias("spans")), next_turn, lambda a: a["spans"])
    return turns.select("conv_id", "leaf", "score", formatted.alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) that a formatted conversation holds."""
    parts = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, F.greatest(F.size(F.split(formatted, "<\\|im_start\\|>")), F.lit(1)))

    def one(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        rest = F.substring(part, F.char_length(role) + 2, F.char_length(part))
        return F.struct(_unescape_role(role).alias("role"), unescape(F.substring_index(rest, END, 1)).alias("text"))

    return F.transform(parts, one)


def read_loss(formatted: Column, loss: Column) -> Column:
    """Text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), "")


def as_chains(rows: DataFrame) -> DataFrame:
    """Reply trees of linear conversations: rows in order of turn, ties by role and text, each answering the one before."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    numbered = rows.select("conv_id", "role", "text", place.alias("node"))
    return numbered.select("conv_id", "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(None).cast("double").alias("score"))
