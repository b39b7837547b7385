"""Languages of documents as mixtures, by expectation-maximisation over character trigrams (operator 11)."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import map_texts


@dataclass(frozen=True)
class Settings:
    """Sizes and weights. A model has ``buckets`` numbers for each language; more than ``most_langs`` languages raise an error."""

    buckets: int = 1 << 16
    most_langs: int = 256
    prior: float = 2000.0  # trigrams of all languages together that a language is given besides its own
    penalty: float = 4.0  # log-likelihood that one more language must gain, times the logarithm of the text's length
    least: float = 0.02  # smallest share of a language in the set
    rounds: int = 60
    close: float = 1e-4  # a round that moves no share by more is the last one
    doubt: float = 10.0  # characters of no language that a score adds to the text


@dataclass(frozen=True)
class Model:
    """Language names in code-point order and, for every bucket, its probability in each; buckets never seen hold ones."""

    langs: list[str]
    chances: np.ndarray


ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PART = 1 << 20  # code points that are hashed at once
CELLS = 1 << 21  # numbers of a matrix that is worked on at once
OVERLAP = 3  # trigrams that read one character: their likelihood counts as a third


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point: 2 for a letter, 1 for a mark that belongs to a word, 0 for anything else."""
    first = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode(), np.uint8)
    return np.where(first == ord("L"), 2, np.where(first == ord("M"), 1, 0)).astype(np.uint8)


def trigrams(text: str, buckets: int):
    """Buckets of the trigrams of a text's words, in arrays for some characters at a time. Words are runs of letters and marks.

    Case is folded, a word has a space before and after it, and no trigram has a space in its middle.
    """
    last = np.zeros(0, np.uint64)
    for k in range(0, len(text) + 1, PART):
        part = text[k : k + PART].lower()
        end = k + PART > len(text)
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(_kinds()[code] > 0, code, 32).astype(np.uint64)
        if k == 0:
            code = np.r_[np.uint64(32), code]
        if end:
            code = np.r_[code, np.uint64(32)]
        code = np.r_[last, code]
        gap = code == 32
        code = code[~(gap & np.r_[False, gap[:-1]])] if len(code) else code
        gram = (code[:-2] * ODD + code[1:-1]) * ODD + code[2:]
        gram = gram[code[1:-1] != 32]
        last = code[-2:]
        yield (((gram ^ (gram >> np.uint64(32))) * MIX) >> np.uint64(33)).astype(np.int64) % buckets


def counted(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text in rising order and how often each occurs."""
    if len(text) < buckets // 8:
        found = np.concatenate(list(trigrams(text, buckets))).astype(np.uint32)
        found.sort()
        edges = np.flatnonzero(np.r_[True, found[1:] != found[:-1], True]) if len(found) else np.zeros(1, np.int64)
        return found[edges[:-1]].astype(np.int64), np.diff(edges)
    total = np.zeros(buckets, np.int64)
    for found in trigrams(text, buckets):
        total += np.bincount(found, minlength=buckets)
    place = np.flatnonzero(total)
    return place, total[place]


def held_out(id_col):
    """Whether a row belongs to the fifth that training must not read; rows without an id do not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, setup: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn trigram probabilities of every language from all documents outside the held-out fifth that have one.

    Counts are summed in the tasks, then by language and bucket; to the driver come at most ``buckets`` of them for a
    language, one language at a time. A language's counts are smoothed towards those of all languages, so a bucket that
    none has seen says nothing. Null languages and texts are left out; an empty table gives a model without languages.
    """
    size, most = setup.buckets, setup.most_langs
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = batch.column(1)
            for k, lang in enumerate(batch.column(0).to_pylist()):
                if lang not in held:
                    if len(held) == most:
                        raise ValueError(f"more than {most} languages")
                    held[lang] = np.zeros(size, np.int64)
                for found in trigrams(texts[k].as_py(), size):
                    held[lang] += np.bincount(found, minlength=size)
        for lang, total in held.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), len(place) + 1), pa.array(np.r_[-1, place], pa.int32()), pa.array(np.r_[0, total[place]], pa.int64()),
            ], names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))  # at most ``buckets`` and one
    found = {}
    for row in packed.select("lang", F.col("cells.bucket").alias("place"), F.col("cells.n").alias("n")).toLocalIterator():
        if len(found) == most:
            raise ValueError(f"more than {most} languages")
        total = np.zeros(size + 1)  # the last one stands for a language without trigrams
        total[row["place"]] = row["n"]
        found[row["lang"]] = total[:size]
    if not found:
        return Model([], np.ones((size, 0), np.float32))
    langs = sorted(found, key=lambda lang: lang.encode("utf-8", "surrogatepass"))
    counts = np.stack([found[lang] for lang in langs], axis=1)
    every = counts.sum(axis=1, keepdims=True)
    every /= max(every.sum(), 1)
    chances = (counts + setup.prior * every) / (counts.sum(axis=0) + setup.prior)
    return Model(langs, np.where(every > 0, chances, 1).astype(np.float32))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0, dtype=np.float64)


def mixtures(places: list[np.ndarray], times: list[np.ndarray], chances: np.ndarray, setup: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Share of each language in each text, zero outside the chosen set, and the set's log-likelihood; texts must hold something.

    The set begins with the likeliest language. The language along which the likelihood rises fastest joins it, shares are
    estimated anew by expectation-maximisation, and the larger set is kept if it gains more than the penalty and each of its
    languages has the least share. A text is left alone at the first set that does not.
    """
    langs, count = chances.shape[1], len(places)
    shares, likelihood = np.zeros((count, langs)), np.zeros(count)
    size = np.array([t.sum() for t in times], np.float64)
    active = np.arange(count)
    members = np.zeros((count, 0), np.int64)
    while len(active):
        length = [len(places[k]) for k in active]
        owner, starts = np.repeat(np.arange(len(active)), length), np.r_[0, np.cumsum(length)[:-1]]
        chance = chances[np.concatenate([places[k] for k in active])]
        often = np.concatenate([times[k] for k in active]).astype(np.float32)
        if not members.shape[1]:
            each = _sums(often[:, None] * np.log(chance), starts)
            best = each.argmax(axis=1)
            shares[active, best], likelihood[active] = 1, each.max(axis=1)
            members = best[:, None]
        else:
            own = np.take_along_axis(shares[active], members, axis=1)
            mixed = (np.take_along_axis(chance, members[owner], axis=1) * own[owner]).sum(axis=1)
            slope = _sums((often / mixed)[:, None] * chance, starts)
            np.put_along_axis(slope, members, -np.inf, axis=1)
            members = np.c_[members, slope.argmax(axis=1)]
            part = np.take_along_axis(chance, members[owner], axis=1)
            share = np.full(members.shape, 1 / members.shape[1])
            for _ in range(setup.rounds):
                joint = part * share[owner].astype(np.float32)
                moved = _sums(joint * (often / joint.sum(axis=1))[:, None], starts) / size[active, None]
                change, share = np.abs(moved - share).max(initial=0), moved
                if change < setup.close:
                    break
            gained = _sums(often * np.log((part * share[owner].astype(np.float32)).sum(axis=1)), starts)
            asked = OVERLAP * setup.penalty * np.log1p(size[active] / OVERLAP)
            kept = (gained - likelihood[active] > asked) & (share.min(axis=1) >= setup.least)
            active, members, share = active[kept], members[kept], share[kept]
            shares[active] = 0
            shares[active[:, None], members] = share
            likelihood[active] = gained[kept]
        if members.shape[1] == langs:
            break
    return shares, likelihood


def _identified(model: Model, setup: Settings):
    """Function of texts for ``map_texts``: languages and shares of each, the largest one and its score."""

    def make(texts: list[str | None]):
        known, places, times = [], [], []
        out = [([], [], "und", 0.0)] * len(texts)

        def settle():
            if known:
                for k, share, size in zip(known, mixtures(places, times, model.chances, setup)[0], [t.sum() for t in times]):
                    order = sorted(np.flatnonzero(share), key=lambda c: (-share[c], c))
                    length = size / OVERLAP
                    score = (share[order[0]] * length + setup.doubt / len(model.langs)) / (length + setup.doubt)
                    out[k] = ([model.langs[c] for c in order], [float(share[c]) for c in order], model.langs[order[0]], float(min(score, 1.0)))
            known.clear(), places.clear(), times.clear()

        cells = 0
        for k, text in enumerate(texts):
            if not text or not model.langs or not any(map(str.isalpha, text)):
                continue
            place, time = counted(text, setup.buckets)
            known.append(k), places.append(place), times.append(time)
            cells += len(place) * len(model.langs)
            if cells > CELLS:
                settle()
                cells = 0
        settle()
        return [list(column) for column in zip(*out)]

    return make


def identify(
    docs: DataFrame, model: Model, setup: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", *, others: tuple[str, ...] = (),
) -> DataFrame:
    """The languages of every whole text: ``doc_id``, ``others``, ``langs`` and their ``shares`` (largest first), ``lang_pred`` and ``score``.

    ``lang_pred`` is the language of the largest share, the first in code-point order of equal ones; ``score`` is its share,
    drawn towards an even split for short texts. One row per row of ``docs``, without a shuffle; the model has a fixed size for
    a language and is broadcast. Texts that are null or have no letter, and all texts under a model without languages, get
    ``und``, 0 and no languages. A text of unknown trigrams only gets the first language with an even score. Repeated rows
    are equal; other columns are not read; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(F.col(id_col).alias("doc_id"), *others, F.col(text_col).alias("_text"))
    return map_texts(base, "_text", lambda texts: _identified(shared.value, setup)(texts), "langs array<string>, shares array<double>, lang_pred string, score double")
