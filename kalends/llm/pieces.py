"""SentencePiece BPE encoding by vectorised merge rounds, and decoding (operator 10)."""

from __future__ import annotations

import re
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import map_texts

#: Fixed values of the model format: piece kinds, and the character that stands for a space.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
SPACE = "▁"
NONE = np.iinfo(np.int64).max


def _fields(data: bytes):
    """Fields ``(number, value)`` of a protocol-buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        if tag & 7 == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], i)
            value, i = data[i : i + size], i + size
        yield tag >> 3, value


class Model:
    """Pieces, merge table and splitting rule of a model file; raises on kinds of model that it does not cover."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        parts = [{1: b"", 2: struct.pack("<f", 0), 3: NORMAL} | dict(_fields(v)) for n, v in top if n == 1]
        trainer, normal = (dict(_fields(next((v for n, v in top if n == k), b""))) for k in (2, 3))
        self.text = [p[1].decode("utf-8") for p in parts]
        self.kind = [p[3] for p in parts]
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("a BPE model with byte fallback and leading spaces is needed")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or not set(self.kind) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model's normalisation or user-defined pieces are not covered")
        self.prefix = bool(normal.get(3, 1))
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        score = [struct.unpack("<f", p[2])[0] for p in parts]
        ids = {t: i for i, t in enumerate(self.text) if self.kind[i] == NORMAL}
        self.byte_id = {int(t[3:5], 16): i for i, t in enumerate(self.text) if self.kind[i] == BYTE}
        merging = [t for t in ids if len(t) > 1]
        # symbols: piece ids, then characters of pieces that are no pieces, then any other character by its code point
        extra = sorted({c for t in merging for c in t} - set(ids))
        symbol = ids | {c: len(parts) + k for k, c in enumerate(extra)}
        self.base = len(parts) + len(extra)
        chars = sorted(c for c in symbol if len(c) == 1)
        self.chars, self.char_symbol = np.array([ord(c) for c in chars], np.int64), np.array([symbol[c] for c in chars], np.int64)
        self.extra = [ord(c) for c in extra]
        order = {s: k for k, s in enumerate(sorted({score[i] for i in ids.values()}, reverse=True))}
        rank = {t: order[score[i]] for t, i in ids.items()}
        self.width = self.base + 0x110000
        pairs = {symbol[t[:k]] * self.width + symbol[t[k:]]: (rank[t], ids[t]) for t in merging for k in range(1, len(t)) if t[:k] in symbol and t[k:] in symbol}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pairs.tolist()], np.int64)
        self.pair_piece = np.array([pairs[k][1] for k in self.pairs.tolist()], np.int64)
        # a rank is calm if no longer piece that starts or ends with its pieces goes before it: all its merges are then independent
        self.calm = np.ones(len(order), bool)
        for t in merging:
            for part in {x for k in range(2, len(t)) for x in (t[:k], t[-k:])} & ids.keys():
                if rank[t] <= rank[part]:
                    self.calm[rank[part]] = False
        self.reach = 2 * max(map(len, merging), default=1)
        inner = any(SPACE in t.lstrip(SPACE) for t in merging)
        known = "".join(sorted({c for t in merging for c in t} - set("" if inner else SPACE)))
        # cut where no merge can cross: before a space after anything else, and around characters that occur in no longer piece
        self.cuts = (f"[{re.escape(known)}]+|." if inner else f"{SPACE}*[{re.escape(known)}]+|{SPACE}+|.") if known else "."
        data = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else t.replace(SPACE, " ").encode() for t, k in zip(self.text, self.kind)]
        self.data, self.data_size = np.frombuffer(b"".join(data), np.uint8), np.array([len(x) for x in data], np.int64)
        self.data_start = np.cumsum(self.data_size) - self.data_size
        self.is_byte = np.array([k == BYTE for k in self.kind])
        self.is_control = np.array([k == CONTROL for k in self.kind])
        self.starts_space = np.array([t.startswith(SPACE) for t in self.text])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
        found = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), bool)
        return np.where(found, self.pair_rank[at], NONE), at

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers.

        All words' symbols lie in one flat array. A round finds the smallest pair rank of each word and merges its pairs
        of that rank from the left: all that do not overlap if the rank is calm, else the leftmost and those so far
        behind the one before that no piece can reach from one to the other. Finished words leave the array.
        """
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        sym = np.where(self.chars[at] == code, self.char_symbol[at], self.base + code)
        place = np.arange(len(sym))
        done_sym, done_word = [], []
        while len(sym):
            rank = np.full(len(sym), NONE)
            pair = np.zeros(len(sym), np.int64)
            rank[:-1], pair[:-1] = self._ranks(sym[:-1], sym[1:])
            change = np.r_[True, word[1:] != word[:-1]]
            rank[:-1][change[1:]] = NONE
            starts = np.flatnonzero(change)
            least = np.minimum.reduceat(rank, starts)
            own = np.repeat(least, np.diff(np.r_[starts, len(sym)]))
            over = own == NONE
            done_sym.append(sym[over])
            done_word.append(word[over])
            spots = np.flatnonzero((rank == own) & ~over)
            if not len(spots):
                break
            first = np.r_[True, word[spots[1:]] != word[spots[:-1]]]
            run = np.r_[True, spots[1:] != spots[:-1] + 1] | first
            even = (np.arange(len(spots)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0
            far = first | np.r_[True, np.diff(place[spots]) >= self.reach]
            spots = spots[np.where(self.calm[rank[spots]], even, far)]
            sym[spots] = self.pair_piece[pair[spots]]
            keep = ~over
            keep[spots + 1] = False
            sym, word, place = sym[keep], word[keep], place[keep]
        sym, word = np.concatenate(done_sym or [sym]), np.concatenate(done_word or [word])
        order = np.argsort(word, kind="stable")
        sym, counts = sym[order], np.bincount(word, minlength=len(words))
        ends = np.cumsum(counts)
        if (sym >= len(self.text)).any():
            return [self._with_bytes(sym[e - n : e].tolist()) for e, n in zip(ends.tolist(), counts.tolist())]
        data = sym.astype("<u4").tobytes()
        return [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist())]

    def _with_bytes(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for s in symbols:
            if s < len(self.text):
                ids.append(s)
            else:
                c = s - self.base if s >= self.base else self.extra[s - len(self.text)]
                ids += [self.byte_id[b] for b in chr(c).encode("utf-8")]
        return np.array(ids, "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: one leading space of the first piece goes; bytes that are no UTF-8 become U+FFFD each."""
        plain = np.flatnonzero(~self.is_control[ids])
        ids = ids[plain[0] : plain[-1] + 1] if len(plain) else ids[:0]
        size = self.data_size[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        data = self.data[np.repeat(self.data_start[ids] - end + size, size) + np.arange(total)].tobytes()
        skip = int(self.prefix and len(ids) > 0 and bool(self.starts_space[ids[0]]))
        try:
            if self.is_control[ids].any():  # it parts bytes that would else be one character
                raise UnicodeDecodeError("utf-8", data, 0, 1, "control piece inside")
            return data[skip:].decode("utf-8")
        except UnicodeDecodeError:
            edges = np.r_[0, np.flatnonzero(np.diff(self.is_byte[ids].astype(np.int8))) + 1, len(ids)]
            parts = []
            for i, j in zip(edges[:-1], edges[1:]):
                part = data[int(end[i] - size[i]) : int(end[j - 1])]
                parts.append(_lenient(part) if self.is_byte[ids[i]] else part.decode("utf-8"))
            return "".join(parts)[skip:]


def _lenient(data: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that starts no valid character."""
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i : i + n].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        i += n
    return "".join(out)


class Coder:
    """Encodes texts with a memory of words; it forgets all when it holds ``most`` of them, so its size is bounded."""

    def __init__(self, model: Model, most: int = 500_000, piece: int = 1 << 20):
        self.model, self.most, self.piece, self.known = model, most, piece, {}
        self.find = re.compile(model.cuts, re.DOTALL).findall
        self.gap = re.compile(f"[^{SPACE}](?={SPACE})")

    def _slices(self, texts: list[str]):
        """Number of a text and its words with space marks, in slices that end before spaces after ``piece`` characters or more."""
        for k, text in enumerate(texts):
            text = (SPACE if self.model.prefix and text else "") + text.replace(" ", SPACE)
            start = 0
            while start < len(text):
                m = self.gap.search(text, start + self.piece)
                end = m.end() if m else len(text)
                yield k, self.find(text[start:end])
                start = end

    def encode(self, texts: list[str], begin: bool, end: bool) -> list[bytes]:
        parts = [[np.array([self.model.bos], "<u4").tobytes()] if begin else [] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for k, words in self._slices(texts):
            waiting.append((k, words))
            size += len(words)
            if size >= self.piece // 2:
                self._flush(waiting, parts)
                waiting, size = [], 0
        self._flush(waiting, parts)
        tail = np.array([self.model.eos], "<u4").tobytes() if end else b""
        return [b"".join(x) + tail for x in parts]

    def _flush(self, waiting: list[tuple[int, list[str]]], parts: list[list[bytes]]) -> None:
        """Encode the words not yet known together, then append the ids of all that wait."""
        seen = set().union(*(words for _, words in waiting))
        new = [w for w in seen if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known, new = {}, list(seen)
        if new:
            self.known.update(zip(new, self.model.encode_words(new)))
        for k, words in waiting:
            parts[k].append(b"".join(map(self.known.__getitem__, words)))


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", *, begin: bool = True, end: bool = True) -> DataFrame:
    """Encode whole texts with a SentencePiece BPE model and decode the ids again, without a shuffle.

    Returns ``doc_id``, ``ids`` (binary: little-endian unsigned 32-bit integers, with begin and end ids if asked for) and
    ``decoded``, one row per row of ``docs``. The model file is read on the driver and broadcast: a vocabulary's size does
    not grow with the corpus. Null and empty texts have only the begin and end ids and decode to an empty text. Repeated
    rows are coded each; other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model(model_path))
    coders: list[Coder] = []  # one for each worker process

    def make(texts: list[str | None]):
        if not coders:
            coders.append(Coder(shared.value))
        ids = coders[0].encode([t or "" for t in texts], begin, end)
        return ids, [coders[0].model.decode(np.frombuffer(x, "<u4")) for x in ids]

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(base, "text", make, "ids binary, decoded string")
