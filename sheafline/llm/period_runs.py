"""Periodic runs of words: stretches that repeat with a period, found by recursive frequency splitting and lag scans.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(``MIN_WORDS``, 2 q) words which no neighbouring word extends at that period. Each of its words occurs at least
twice in it. So a word that occurs once in its segment, at first the whole text, is in no run and splits it; parts of
fewer than ``MIN_WORDS`` words go; parts are counted again until nothing changes. All texts of a batch are split at
once. After ``ROUNDS`` recounts, which only contrived texts reach, the rest is scanned as it stands: splitting saves
work and decides nothing.

What survives is scanned lag by lag. A segment is halved; for each lag the equal stretch around the middle is measured
once from either side, and the halves follow, so that a segment of n words takes n log n measurements instead of n
squared comparisons. A stretch is measured by hashes of blocks whose sizes are powers of two. Where several lags give
the same stretch the smallest is its period.

Words are split at ASCII white space and compared by 64-bit hashes. Null and empty texts have no runs and an empty
collapsed text. Runs are ordered by start, then period, so ties and reruns agree; repeated rows get equal results; an
empty table gives an empty result. A text of any length is searched whole. Other columns pass through; clashing output
columns are replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches

MIN_WORDS = 12
ROUNDS = 64
#: Blocks of up to 2 ** TOP words have hashes of their own; longer stretches are measured in steps of that size.
TOP = 16
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def split(values: np.ndarray, row: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first, end) of the segments that splitting leaves, a pair of arrays for each round in which some were stable."""
    done = []
    at, segment = np.arange(len(values)), row
    _, code = np.unique(values, return_inverse=True)
    for turn in range(ROUNDS + 1):
        if not len(at):
            break
        if turn < ROUNDS:
            _, word, times = np.unique(segment * (code.max() + 1) + code, return_inverse=True, return_counts=True)
            keep = times[word] > 1
        else:
            keep = np.ones(len(at), bool)
        size = np.bincount(segment)
        at, segment, code = at[keep], segment[keep], code[keep]
        if not len(at):
            break
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) > 1) | (np.diff(segment) != 0)
        first = np.flatnonzero(fresh)
        length = np.diff(np.append(first, len(at)))
        stable = length == size[segment[first]]
        here = stable & (length >= MIN_WORDS)
        done.append((at[first[here]], at[first[here]] + length[here]))
        go = ~stable & (length >= MIN_WORDS)
        chosen = np.repeat(go, length)
        at, code = at[chosen], code[chosen]
        segment = np.repeat(np.arange(go.sum()), length[go])
    return done


class Blocks:
    """Hashes of all blocks of 1, 2, 4, ... values, and the extent of equal stretches by them."""

    def __init__(self, values: np.ndarray, longest: int):
        self.names = [values]
        for k in range(min(TOP, max(1, longest).bit_length() - 1)):
            a = self.names[-1]
            half = 1 << k
            if len(a) <= half:
                break
            b = a[half:]
            self.names.append(tb.mixed(a[: len(b)] * np.uint64(0x9E3779B97F4A7C15) + tb.mixed(b + np.uint64(k + 1))))

    def extent(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many values from i and j on are equal, forwards (step 1) or backwards (step -1), up to ``most``."""
        out = np.zeros(len(i), np.int64)
        top = len(self.names) - 1
        for k in range(top, -1, -1):
            size, names = 1 << k, self.names[k]
            back = 0 if step > 0 else size - 1
            live = np.arange(len(i))
            while len(live):
                live = live[out[live] + size <= most[live]]
                shift = step * out[live] - back
                live = live[names[i[live] + shift] == names[j[live] + shift]]
                out[live] += size
                if k < top:
                    break
        return out


def scan(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs inside the segments, by start, then end."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3]
    blocks = Blocks(values, int((end - first).max(initial=1)))
    left, right, low, high = first, end, first, end
    while len(left):
        lags = (right - left) // 2
        block = np.repeat(np.arange(len(left)), lags)
        q = np.arange(len(block)) - np.repeat(np.cumsum(lags) - lags, lags) + 1
        middle = ((left + right) // 2)[block]
        for i in (middle, middle - q):
            # The stretch of t with value t = value t + q around i, where it touches i from either side.
            b = block
            ahead = (i + q < high[b]) & (values[i] == values[np.minimum(i + q, len(values) - 1)])
            behind = (i > low[b]) & (values[i - 1] == values[i + q - 1])
            near = ahead | behind
            i, b, lag = i[near], b[near], q[near]
            after = blocks.extent(i, i + lag, high[b] - i - lag, 1)
            before = blocks.extent(i - 1, i + lag - 1, i - low[b], -1)
            long = after + before + lag >= np.maximum(MIN_WORDS, 2 * lag)
            found.append(((i - before)[long], (i + lag + after)[long], lag[long]))
        middle = (left + right) // 2
        left, right = np.concatenate([left, middle]), np.concatenate([middle, right])
        low, high = np.concatenate([low, low]), np.concatenate([high, high])
        big = right - left >= MIN_WORDS
        left, right, low, high = left[big], right[big], low[big], high[big]
    start, stop, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (np.diff(start) != 0) | (np.diff(stop) != 0)
    return start[fresh], stop[fresh], period[fresh]


def runs_in(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of many texts: the values of their words and the text of each word."""
    parts = split(values, row)
    first, end = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in range(2))
    size = end - first
    if not len(first):
        return scan(values[:0], first, end)
    # The segments side by side: only they are hashed.
    base = np.cumsum(size) - size
    away = np.repeat(first - base, size)
    start, stop, period = scan(values[np.arange(len(away)) + away], base, base + size)
    start, stop = start + away[start], stop + away[start]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def find_runs(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period of each) and ``collapsed``, the words without repetitions.

    A word goes from ``collapsed`` if a run contains it after that run's first period; the others are joined by one
    space. ``keep_text=False`` leaves the text column out.
    """
    small_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed") and (keep_text or f.name != text)]
    schema = T.StructType([*kept, T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(text)):
                starts, ends, row = tb.spans(tb.GAP[buf], off)
                start, stop, period = runs_in(tb.hashed(buf, starts, ends), row)
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                change = np.zeros(len(row) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, stop, -1)
                stays = np.cumsum(change[:-1]) == 0
                owner = row[start]
                count = np.bincount(owner, minlength=b - a)
                data = buf.tobytes()
                collapsed = []
                for i, some in enumerate(count.tolist()):
                    words = data[off[i] : off[i + 1]].split()
                    collapsed.append(b" ".join(compress(words, stays[bounds[i] : bounds[i + 1]]) if some else words))
                structs = pa.StructArray.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in (start - bounds[owner], stop - start, period)],
                    fields=[pa.field(c, pa.int64(), False) for c in ("start", "length", "period")],
                )
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), structs)
                part = batch.slice(a, b - a)
                columns = [part.column(c) for c in names]
                texts = pa.array(collapsed, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, lists, texts], names=schema.names)

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)
