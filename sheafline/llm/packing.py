"""Packing token sequences: bounded-space online best fit.

Each task tokenises its documents, ends each with one id, and keeps at most ``OPEN`` windows of ``WINDOW`` tokens
open. A document of more than a window fills windows of its own first. What is left goes to the open window with the
least sufficient room. When none fits and ``OPEN`` are open, the fullest is topped up with the head of the document
and emitted, so it has no padding. Windows that are still open at the end of a task are merged: best fit by falling
size among groups of about ``MERGE_WINDOWS`` of them, without cutting. Only the last windows of such a group are padded.

Every id lies in exactly one piece; a sequence's pieces are gapless from offset 0. Null text counts as empty: its
document is the end id alone. Repeated rows are documents of their own. An empty table gives no piece. Other columns
are ignored; ``doc_id`` may be null. The pieces are written to the shared folder once, so that the merge sees the
same windows if a task is repeated.

Words are tokenised once per worker: a bounded table maps a word's 64-bit hash to its ids. Splitting at ASCII white
space first is exact for a tokenizer that drops white space and never merges across it, as the given one.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches, stored

WINDOW = 2048
OPEN = 16
END_ID = 1
MERGE_WINDOWS = 4_096
TOKENIZER = "word_bpe_49k.json"
#: Bytes of text tokenised at once: new words are merged into the table once per run.
RUN_BYTES = 2 << 20
#: Words remembered by a worker before it starts afresh; about 60 bytes each.
WORDS = 1_000_000
#: Pieces of words remembered besides; Python objects, some 200 bytes each.
PIECES = 100_000

_PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, window bigint, offset bigint, open boolean"


class WordIds:
    """Token ids of words, remembered by hash."""

    #: How the tokenizer cuts lower-case ASCII words into pieces.
    _PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        """Forget all words."""
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.pieces: dict[str, list[int]] = {}

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; plain lower-case ASCII pieces skip the tokenizer's normaliser."""
        out: list[list[int] | None] = []
        hard = []
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        for word in words:
            if word.isascii() and "<|" not in word and word.isprintable():
                ids: list[int] = []
                for piece in self._PIECES.findall(word.lower()):
                    known = self.pieces.get(piece)
                    if known is None:
                        known = self.pieces[piece] = [t.id for t in self.model.tokenize(piece)]
                    ids += known
                out.append(ids)
            else:
                out.append(None)
                hard.append(word)
        found = iter(self.tokenizer.encode_batch(hard, add_special_tokens=False)) if hard else iter(())
        return [next(found).ids if ids is None else ids for ids in out]

    def of_run(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts, and how many each text has."""
        starts, ends, row = tb.spans(tb.GAP[buf], off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        h = tb.hashed(buf, starts, ends)
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == unique[inside]
        if not known.all():
            if len(self.keys) + len(unique) > WORDS:
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            data = buf.tobytes()
            encoded = self.encode(
                [data[s:e].decode() for s, e in zip(starts[first[new]], ends[first[new]], strict=True)]
            )
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(size.sum()))
            at = len(self.ids) + np.cumsum(size) - size
            where = np.searchsorted(self.keys, unique[new])
            self.keys = np.insert(self.keys, where, unique[new])
            self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, size)
            self.ids = np.concatenate([self.ids, flat])
            place = np.searchsorted(self.keys, unique)
        at, count = self.at[place][inverse], self.count[place][inverse]
        ends_at = np.cumsum(count)
        source = np.arange(ends_at[-1]) + np.repeat(at - (ends_at - count), count)
        return self.ids[source], np.bincount(row, count, len(off) - 1).astype(np.int64)


_WORKER: dict[str, WordIds] = {}


def word_ids(path: str | None) -> WordIds:
    """The worker's table for a tokenizer file; by default the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _WORKER:
        _WORKER[path] = WordIds(path)
    return _WORKER[path]


class Packer:
    """The open windows of one task."""

    def __init__(self, part: int, window: int = WINDOW, keep: int = OPEN):
        self.next_id, self.window, self.keep = part << 32, window, keep
        self.rooms: list[tuple[int, int]] = []  # (room, window id), ascending

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, length: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a document: (start, length, window id, offset)."""
        out, start = [], 0
        while length - start >= self.window:
            out.append((start, self.window, self._new(), 0))
            start += self.window
        left = length - start
        if not left:
            return out
        i = bisect.bisect_left(self.rooms, (left, -1))
        if i == len(self.rooms) and len(self.rooms) >= self.keep:
            room, fullest = self.rooms.pop(0)
            out.append((start, room, fullest, self.window - room))
            start, left = start + room, left - room
            i = bisect.bisect_left(self.rooms, (left, -1))
        if i < len(self.rooms):
            room, at = self.rooms.pop(i)
        else:
            room, at = self.window, self._new()
        out.append((start, left, at, self.window - room))
        if room > left:
            bisect.insort(self.rooms, (room - left, at))
        return out


def pieces(docs: DataFrame, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """Pieces of every document with the window they lie in; ``open`` marks windows that were not filled."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        table = word_ids(tokenizer)
        packer = Packer(TaskContext.get().partitionId())
        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for a, b, buf, off in tb.runs(batch.column(text), RUN_BYTES):
                ids, counts = table.of_run(buf, off)
                ends = np.cumsum(counts)
                done = []
                for i in range(b - a):
                    own = np.append(ids[ends[i] - counts[i] : ends[i]], np.uint32(END_ID)).astype("<u4")
                    for start, length, window, offset in packer.place(len(own)):
                        crc = zlib.crc32(own[start : start + length].tobytes())
                        waiting.setdefault(window, []).append(
                            (names[a + i], start, length, crc, len(own), window, offset)
                        )
                        if offset + length == WINDOW:
                            done += waiting.pop(window)
                if done:
                    yield _rows(done, False, id_type_arrow)
        last = [p for ps in waiting.values() for p in ps]
        if last:
            yield _rows(last, True, id_type_arrow)

    id_type_arrow = pa.int64() if id_type == "bigint" else pa.string()
    chosen = docs.select(F.col("doc_id").cast("bigint" if id_type == "bigint" else "string"), text)
    return chosen.mapInArrow(run, f"doc_id {'bigint' if id_type == 'bigint' else 'string'}, {_PIECE}")


def _rows(found: list[tuple], still_open: bool, id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True))
    arrays = [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]]
    arrays.append(pa.array([still_open] * len(found)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "open"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def merged(windows: DataFrame) -> DataFrame:
    """Where each unfilled window (columns window, fill) goes: window, sequence_id, base."""
    groups = max(1, -(-windows.count() // MERGE_WINDOWS))

    def place(frame):
        frame = frame.sort_values(["fill", "window"], ascending=[False, True])
        rooms: list[tuple[int, int]] = []
        sequence, base = [], []
        for fill, window in zip(frame["fill"], frame["window"], strict=True):
            i = bisect.bisect_left(rooms, (fill, -1))
            room, at = rooms.pop(i) if i < len(rooms) else (WINDOW, window)
            sequence.append(at)
            base.append(WINDOW - room)
            if room > fill:
                bisect.insort(rooms, (room - fill, at))
        frame = frame[["window"]].copy()
        frame["sequence_id"], frame["base"] = sequence, base
        return frame

    grouped = windows.withColumn("__g", F.pmod(F.xxhash64("window"), F.lit(groups)))
    return grouped.groupBy("__g").applyInPandas(
        lambda frame: place(frame), "window bigint, sequence_id bigint, base bigint"
    )


def pack(docs: DataFrame, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    small_batches(docs.sparkSession)
    placed = stored(pieces(docs, tokenizer, text), "pieces")
    unfilled = placed.where("open")
    moves = merged(unfilled.groupBy("window").agg(F.sum("length").alias("fill")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = placed.where("not open").select(*columns, F.col("window").alias("sequence_id"), "offset")
    joined = unfilled.join(moves, "window").select(
        *columns, "sequence_id", (F.col("base") + F.col("offset")).alias("offset")
    )
    return full.unionByName(joined)
