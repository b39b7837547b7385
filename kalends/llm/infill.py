"""Fill-in-middle transformation of texts cut at line ends, found in an indexable skip list (operator 13)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
STEP = 4 << 20  # code points of output that leave a task at once, unless one text is longer
ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def line_widths(text: str) -> np.ndarray:
    """Code points of each line of ``text``, its line feed included; what follows the last line feed is a line if it is not empty."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts = np.r_[0, np.flatnonzero(data == 10) + 1]
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)  # bytes that begin a code point


@dataclass(frozen=True)
class Lane:
    """Links of one lane: the units and code points that each of them passes, and the place of its start in the lane below."""

    units: np.ndarray
    chars: np.ndarray
    down: np.ndarray


class SkipList:
    """Units of one text by rank. Every lane keeps the first link and about a quarter of the starts of the lane below."""

    def __init__(self, widths: np.ndarray):
        lane = Lane(np.ones(len(widths), np.int64), np.asarray(widths, np.int64), np.arange(len(widths)))
        self.lanes = [lane]
        while len(lane.units) > 4:
            seed = (np.arange(len(lane.units), dtype=np.uint64) << np.uint64(5)) + np.uint64(len(self.lanes))
            coin = seed * MIX
            coin = (coin ^ (coin >> np.uint64(31))) * ODD
            keep = (coin >> np.uint64(62)) == 0
            keep[0] = True
            starts = np.flatnonzero(keep)
            lane = Lane(np.add.reduceat(lane.units, starts), np.add.reduceat(lane.chars, starts), starts)
            self.lanes.append(lane)

    def chars_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units: right while the accumulated units allow it, else one lane down."""
        link = units = chars = 0
        for lane in reversed(self.lanes):
            while link < len(lane.units) and units + lane.units[link] <= rank:
                units, chars, link = units + int(lane.units[link]), chars + int(lane.chars[link]), link + 1
            if units == rank or link == len(lane.units):
                break
            link = int(lane.down[link])
        if units != rank:
            raise IndexError(f"rank {rank} is outside the list")
        return chars


def draws(seed: int, key: int | None) -> list[int]:
    """Four 32-bit numbers of a document: the first groups of eight digits of a hash of seed and id (a null id is written ``null``)."""
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def infill(text: str, h: list[int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Number of lines, form, code points of prefix and middle, and the output of one text."""
    widths = line_widths(text)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return len(widths), "plain", None, None, text
    ranks, lines = sorted(x % (len(widths) + 1) for x in h[:2]), SkipList(widths)
    one, two = map(lines.chars_before, ranks)
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if h[3] % 100 < spm:
        return len(widths), "spm", one, two - one, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return len(widths), "psm", one, two - one, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = 7, rate: int = 100, spm: int = 50, others: tuple[str, ...] = (),
) -> DataFrame:
    """Rearrange every text for training on infilling: a prefix, a middle and a suffix, each of whole lines, with their marks.

    A hash of ``seed`` and the id gives two cut ranks among the lines, and says whether the text stays ``plain`` (``rate``
    percent do not) and whether the suffix comes first (``spm`` percent) or the prefix (``psm``). Texts that are empty or hold
    one of the marks are plain. Both ranks are looked up in a skip list whose express lanes carry lines and code points.

    Returns one row per row of ``docs``, without a shuffle: ``doc_id``, ``others`` as they are, ``n`` (lines), ``form``,
    ``prefix_chars`` and ``middle_chars`` (code points, null if plain) and ``output``. Null texts count as empty, a null id is
    an id of its own; rows with equal id and text give equal rows; other columns are not read; an empty table gives none.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), *others, F.col(text_col).alias("_text"))
    made = StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string").fields
    schema = StructType([*base.schema.fields[:-1], *made])
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            kept, ids, texts = batch.num_columns - 1, batch.column(0), batch.column(batch.num_columns - 1)
            start, size, rows = 0, 0, []
            for k in range(batch.num_rows):
                text = texts[k].as_py() or ""
                rows.append(infill(text, draws(seed, ids[k].as_py()), rate, spm))
                size += len(text)
                if size > STEP or k + 1 == batch.num_rows:
                    arrays = [batch.column(c).slice(start, k + 1 - start).cast(out[c].type) for c in range(kept)]
                    arrays += [pa.array(values, out[kept + c].type) for c, values in enumerate(zip(*rows))]
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)
                    start, size, rows = k + 1, 0, []

    return base.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text before ``transform``, from its output and form: between the marks lie prefix, suffix and middle, or suffix, prefix and middle."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
