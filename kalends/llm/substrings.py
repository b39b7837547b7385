"""Substring deduplication by suffix automata of repeated reference passages (operator 4)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import stored

BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base)], dtype=np.uint64)


SLICE = 1 << 16
DEALS = 64  # parts in which the passages of an owner learn how often its reference is sent
FORTH, BACKWARDS = _powers(BASE, SLICE), _powers(BACK, SLICE)
GAP = re.compile(rb"[ \t-\r]")


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MIX
    return hashes ^ (hashes >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, none 0: polynomials over slices of it; XXH64 for words of ``SLICE`` bytes or more."""
    data, at, out = text.encode("utf-8"), 0, [np.zeros(0, np.uint64)]
    while at < len(data):
        part = np.frombuffer(data, np.uint8, min(SLICE, len(data) - at), at)
        gap = (part == 32) | ((part >= 9) & (part <= 13))
        if len(part) == SLICE:
            last = SLICE - 1 - int(gap[::-1].argmax())
            if not gap[last]:
                found = GAP.search(data, at + SLICE)
                end = found.start() if found else len(data)
                out.append(np.array([xxhash.xxh64_intdigest(data[at:end]) or 1], np.uint64))
                at = end
                continue
            part, gap = part[: last + 1], gap[: last + 1]
        padded = np.r_[True, gap, True]
        edges = np.flatnonzero(padded[1:] != padded[:-1])
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * FORTH[: len(part)], out=total[1:])
        out.append(np.maximum(_mixed((total[edges[1::2]] - total[edges[::2]]) * BACKWARDS[edges[::2]]), np.uint64(1)))
        at += len(part)
    return np.concatenate(out)


class Windows:
    """Rolling hashes of the windows of a word sequence, and the anchor of each: its least hashed run of ``gram`` words, the first of equals."""

    def __init__(self, window: int, gram: int, most: int = 1 << 16):
        self.window, self.gram = window, gram
        self.forth, self.back = _powers(BASE, most), _powers(BACK, most)

    def _runs(self, hashes: np.ndarray, size: int) -> np.ndarray:
        n = len(hashes)
        if n >= len(self.forth):
            self.forth, self.back = _powers(BASE, 2 * n), _powers(BACK, 2 * n)
        total = np.r_[np.uint64(0), np.cumsum(hashes * self.forth[:n], dtype=np.uint64)]
        return _mixed((total[size:] - total[: n - size + 1]) * self.back[: n - size + 1])

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash of each window's anchor, for every start of a window; places never go back."""
        grams, out = self._runs(hashes, self.gram), []
        wide = self.window - self.gram + 1
        for at in range(0, len(grams) - wide + 1, 1 << 16):
            part = grams[at : at + (1 << 16) + wide - 1]
            place = np.lib.stride_tricks.sliding_window_view(part, wide).argmin(axis=1)
            out.append(at + np.arange(len(place)) + place)
        place = np.concatenate(out)
        return place, grams[place]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self._runs(hashes, self.window)


class Automaton:
    """Suffix automaton of a sequence of numbers."""

    def __init__(self, sequence: list[int]):
        self.next, self.link, self.length = [{}], [-1], [0]
        last = 0
        for c in sequence:
            state, p = len(self.next), last
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[state] = q
                else:
                    copy = len(self.next)
                    self.next.append(self.next[q].copy())
                    self.link.append(self.link[q])
                    self.length.append(self.length[p] + 1)
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = self.link[p]
                    self.link[q] = self.link[state] = copy
            last = state

    def spans(self, sequence: list[int], least: int) -> list[tuple[int, int]]:
        """Maximal spans (start, end) covered by matches of ``least`` or more numbers, from the matching statistics."""
        state = size = 0
        found: list[tuple[int, int]] = []
        for end, c in enumerate(sequence, 1):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state, size = self.next[state][c], size + 1
            if size >= least:
                if found and found[-1][1] >= end - size:
                    found[-1] = (min(found[-1][0], end - size), end)
                else:
                    found.append((end - size, end))
        return found


    def windows(self, sequence: list[int], size: int) -> Iterator[tuple[int, int]]:
        """End and state of every ``size`` numbers of ``sequence`` that occur in the automaton; equal ones have one state of their own.

        The matching statistics are cut off at ``size``: a longer match goes back along the links to the state of its last ``size`` numbers.
        """
        state = held = 0
        for end, c in enumerate(sequence, 1):
            while state and c not in self.next[state]:
                state = self.link[state]
                held = self.length[state]
            if c in self.next[state]:
                state, held = self.next[state][c], held + 1
            if held >= size:
                held = size
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                yield end, state


def _joined(starts: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the spans that windows of ``size`` at rising ``starts`` cover."""
    starts = np.asarray(starts, np.int64)
    gap = np.flatnonzero(np.diff(starts) > size) + 1
    first = starts[np.r_[0, gap]]
    return first, starts[np.r_[gap - 1, len(starts) - 1]] + size - first


def _rows(df: DataFrame, make, names: str) -> DataFrame:
    """Rows that ``make(key, text)`` returns as arrays for each row (key, text), with the key in front."""
    kinds = [pa.int64() if f.split()[1] == "long" else pa.int32() for f in names.split(", ")]
    labels = ["key", *(f.split()[0] for f in names.split(", "))]

    def run(batches):
        for batch in batches:
            keys, parts, size = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                made = make(text.as_py() or "")
                if made is None or not len(made[0]):
                    continue
                keys.append(np.full(len(made[0]), key))
                parts.append(made)
                size += len(made[0])
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(pa.array(np.concatenate(c), k) for c, k in zip(zip(*parts), kinds))], labels)
                    keys, parts, size = [], [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(pa.array(np.concatenate(c), k) for c, k in zip(zip(*parts), kinds))], labels)

    return df.mapInArrow(run, "key long, " + names)


def _anchor_filter(texts: DataFrame, window: int, gram: int, bits: int) -> np.ndarray:
    """Bit table of the anchors that occur more than once; its size is fixed, and so is what comes to the driver."""
    def make(text: str):
        words = word_hashes(text)
        if len(words) < window:
            return None
        place, found = tools.anchors(words)
        values, counts = np.unique(found[np.r_[True, place[1:] != place[:-1]]], return_counts=True)
        return values.view(np.int64), counts.astype(np.int32)

    tools = Windows(window, gram)
    anchors = _rows(texts, make, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    place = F.shiftrightunsigned("anchor", 64 - bits)
    cells = anchors.groupBy(F.shiftrightunsigned(place, 6).cast("int").alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - bits}) & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (bits - 6), np.uint64)
    found = cells.toArrow()
    table[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def _passages(window: int):
    """For each row (key, text, copies, windows): its reference passages and its probes of others' passages, as hashed words."""
    names = ["owner", "key", "copies", "starts", "sizes", "words"]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                key = batch.column("key")[r].as_py()
                word = word_hashes(batch.column("text")[r].as_py())
                rows = []
                for found in batch.column("found")[r]:
                    first, size = _joined(np.unique(found["starts"].values.to_numpy()), window)
                    parts = [x for i, n in zip(first, size) for x in (word[i : i + n], np.zeros(1, np.uint64))]
                    owner = found["ref"].as_py()
                    copies = batch.column("copies")[r].as_py() if owner == key else 0
                    rows.append((owner, key, copies, first.tolist(), size.tolist(), np.concatenate(parts).tobytes()))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run, "owner long, key long, copies long, starts array<int>, sizes array<int>, words binary"


class Reference:
    """The automaton of one document's reference passages, and which of its windows it has met anywhere else."""

    def __init__(self, key: int, copies: int, starts: list[int], sizes: list[int], words: bytes, window: int):
        self.key, self.window, self.own, self.times, self.met = key, window, [], Counter(), set()
        numbers = np.frombuffer(words, np.uint64).tolist()
        cuts = iter(range(-1, -len(numbers) - 1, -1))  # each end of a passage is a number of its own
        self.automaton = Automaton([x or next(cuts) for x in numbers])
        for start, end, state in self.stream(starts, sizes, numbers):
            self.own.append((start + end - window, state))
            self.times[state] += copies

    def stream(self, starts: list[int], sizes: list[int], numbers: list[int]):
        at = 0
        for start, size in zip(starts, sizes):
            for end, state in self.automaton.windows(numbers[at : at + size], self.window):
                yield start, end, state
            at += size + 1

    def probe(self, starts: list[int], sizes: list[int], words: bytes) -> list[int]:
        """Starts of a probe's windows that occur in the reference, in rising order; the reference learns that they occur elsewhere."""
        found = []
        for start, end, state in self.stream(starts, sizes, np.frombuffer(words, np.uint64).tolist()):
            self.met.add(state)
            found.append(start + end - self.window)
        return found

    def repeated(self) -> list[int]:
        """Starts of the reference's own windows that occur in a probe, or more than once in the reference itself."""
        return [start for start, state in self.own if state in self.met or self.times[state] > 1]


def _stream(window: int):
    """Spans of references and probes that occur elsewhere too; rows come sorted, each reference before its probes."""
    def run(batches):
        reference, group, out = None, None, []

        def note(key: int, starts: list[int]) -> None:
            if starts:
                first, size = _joined(starts, window)
                out.append((np.full(len(first), key), first, size))

        def passed_on():
            keys, starts, sizes = (np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ((), (), ())))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts.astype(np.int32)), pa.array(sizes.astype(np.int32))], ["key", "start", "size"])

        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                if group != (row["owner"], row["salt"]):
                    if reference is not None:
                        note(reference.key, reference.repeated())
                    group = row["owner"], row["salt"]
                    reference = Reference(row["key"], row["copies"], row["starts"], row["sizes"], row["words"], window)
                else:
                    note(row["key"], reference.probe(row["starts"], row["sizes"], row["words"]))
            yield passed_on()
        if reference is not None:
            note(reference.key, reference.repeated())
            yield passed_on()

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 35, gram: int = 12, bits: int = 28, probes: int = 2000) -> DataFrame:
    """Remove every word covered by ``window`` consecutive words that also start anywhere else in the table.

    1. Every window is anchored at its least hashed run of ``gram`` words; equal windows have equal anchors. Anchors that occur
       more than once are marked in a bit table of fixed size, which is broadcast. Where it is crowded, more windows are candidates.
    2. Windows with a marked anchor are counted by hash, pre-aggregated. This only says which passages meet which: of windows that may
       occur more than once, the places in the document with the smallest key make its reference passages, the others its probes.
    3. A suffix automaton is built of each document's reference passages. The probes stream through it, and so do the passages
       themselves: the matching statistics say which windows of a probe occur in the reference, and which of the reference's
       own windows a probe met or the reference holds twice. Those spans are removed, of references and probes alike.

    All windows are judged on the input. Words are compared by 64-bit hashes. Documents are told apart by a 64-bit hash of
    id and text, so rows that repeat both share their spans, and each counts as a place. Null texts and those shorter than a
    window lose nothing. An automaton holds the repeated words of one document; a reference goes once to every ``probes`` documents
    that name it, so those of a hot one are dealt to several tasks. Texts are shuffled once, by document.

    Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (words joined by one space), one row per row of ``docs``; other
    columns are not read, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(_anchor_filter(texts.select("key", "text"), window, gram, bits))
    tools = Windows(window, gram)

    def candidates(text: str):
        words = word_hashes(text)
        if len(words) < window:
            return None
        place = tools.anchors(words)[1] >> np.uint64(64 - bits)
        starts = np.flatnonzero((shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
        return (tools.of(words)[starts].view(np.int64), starts) if len(starts) else None

    windows = stored(_rows(texts.select("key", "text"), candidates, "hash long, start int"), "windows")
    first = stored(windows.groupBy("hash").agg(F.min("key").alias("ref"), F.count("*").alias("n")).where("n > 1").select("hash", "ref"), "first")
    pairs = windows.join(first, "hash").groupBy("key", "ref").agg(F.collect_set("start").alias("starts"))
    found = pairs.groupBy("key").agg(F.collect_list(F.struct("ref", "starts")).alias("found"))
    found = stored(found, "repeats")
    cut, fields = _passages(window)
    distinct = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))  # rows that repeat one would only give the same passages
    passages = stored(distinct.join(found, "key").select("key", "text", "copies", "found").mapInArrow(cut, fields), "passages")
    shares = passages.groupBy("owner").agg(F.ceil(F.count("*") / probes).alias("shares")).where("shares > 1")
    shares = shares.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))  # hot owners only, met part by part
    parted = passages.withColumn("part", F.pmod(F.xxhash64("owner", "key"), F.lit(DEALS)).cast("int"))
    dealt = parted.join(shares, ["owner", "part"], "left").withColumn("shares", F.coalesce("shares", F.lit(1)).cast("long"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)
    salt = F.explode(F.when(F.col("copies") > 0, everywhere).otherwise(F.array(F.pmod(F.xxhash64("key"), "shares"))))
    dealt = dealt.select("owner", salt.alias("salt"), "key", "copies", "starts", "sizes", "words")
    ordered = dealt.repartition("owner", "salt").sortWithinPartitions("owner", "salt", F.col("copies").desc())
    matched = ordered.mapInArrow(_stream(window), "key long, start int, size int")
    spans = matched.groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    joined = texts.join(spans, "key", "left").select("doc_id", "spans", "text")

    def remove(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                totals, gone, kept = [], [], []
                for spans, text in zip(part.column("spans").to_pylist(), part.column("text").to_pylist()):
                    words = (text or "").encode("utf-8").split()
                    change = np.zeros(len(words) + 1, np.int64)
                    for s in spans or ():
                        change[s["start"]] += 1
                        change[s["start"] + s["size"]] -= 1
                    keep = np.cumsum(change[:-1]) == 0
                    left = [words[k] for k in np.flatnonzero(keep)] if spans else words
                    totals.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode("utf-8"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept string")
