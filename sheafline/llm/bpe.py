"""BPE encoding and decoding: greedy longest match proposes tokens, a check of every adjacent pair accepts them.

A word's encoding is right exactly if each token is the encoding of its own symbols and no merge across the border of
two neighbours would have come before the merges that made them. So a word is first cut by longest match (all words
and positions of a batch walk one trie at once); then every adjacent pair of all words is checked at once, by undoing
the later of the two border tokens step by step and looking up what could have merged there. Only words with a failing
pair are merged exactly, lowest rank first. Proposals use only tokens that pass the same check on their own two parts.

Words are cut at ASCII white space, which the given tokenizer drops and never merges across; the rest of its normaliser
and its cutting of words into pieces are those of the tokenizer file. A worker remembers a bounded number of words and
pieces. The tokenizer file is a parameter and is read on the executors.

Null text counts as empty and has no ids; null ids decode to an empty text, and ids outside the vocabulary are passed
over. Repeated rows get equal results; an empty table gives an empty result. A text of any length is encoded whole.
Other columns pass through; clashing output columns are replaced.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches
from sheafline.llm.packing import RUN_BYTES, TOKENIZER, WordIds

#: Pieces of words remembered by a worker before it starts afresh; Python objects, some 200 bytes each.
PIECES = 200_000
#: Bytes of ids that one outgoing batch holds at most, but for a longer text.
OUT_BYTES = 4 << 20
#: Pieces of up to so many symbols are merged together, longer ones one by one; the steps are the same.
TOGETHER = (8, 16, 32, 64)
_END = 256
_NEVER = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one above 255."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """The merges of a tokenizer as arrays. Symbols 0..255 are bytes, 256..511 bytes that end a word."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        size = max(vocab.values()) + 1
        symbols = byte_letters() + [c + suffix for c in byte_letters()]
        self.symbol_id = np.array([vocab[s] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = size
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        order = np.arange(len(pairs))
        self.rank[made], self.left[made], self.right[made] = order, left, right
        if len(np.unique(made)) < len(made) or (np.maximum(self.rank[left], self.rank[right]) >= order).any():
            raise ValueError("each merge must make a new token out of earlier ones")
        keys = left * size + right
        by_key = np.argsort(keys)
        self.keys, self.key_rank = keys[by_key], order[by_key]
        self.made = made
        self.spelt = self._spelt()
        self.whole = np.zeros(size, bool)
        self.whole[self.symbol_id] = True
        sound = self.compatible(left, right, order)
        for token, ok in zip(made.tolist(), sound.tolist(), strict=True):
            self.whole[token] = ok and self.whole[self.left[token]] and self.whole[self.right[token]]
        self._trie()

    def _spelt(self) -> list[tuple[int, ...] | None]:
        spelt: list[tuple[int, ...] | None] = [None] * self.size
        for symbol, token in enumerate(self.symbol_id.tolist()):
            spelt[token] = (symbol,)
        for token in self.made.tolist():
            spelt[token] = spelt[self.left[token]] + spelt[self.right[token]]
        return spelt

    def _trie(self) -> None:
        """Nodes by level: (node, symbol) -> node as sorted keys, and the token that ends at a node."""
        tokens = np.flatnonzero(self.whole)
        length = np.array([len(self.spelt[t]) for t in tokens])
        node = np.zeros(len(tokens), np.int64)
        keys, children, accepts, count = [], [], [np.full(1, -1, np.int64)], 1
        for depth in range(int(length.max())):
            here = np.flatnonzero(length > depth)
            symbol = np.array([self.spelt[t][depth] for t in tokens[here]], np.int64)
            unique, inverse = np.unique(node[here] * 512 + symbol, return_inverse=True)
            keys.append(unique)
            children.append(count + np.arange(len(unique)))
            node[here] = count + inverse
            accept = np.full(len(unique), -1, np.int64)
            ends = length[here] == depth + 1
            accept[inverse[ends]] = tokens[here][ends]
            accepts.append(accept)
            count += len(unique)
        key, child = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(key)
        self.edge, self.child, self.accept = key[order], child[order], np.concatenate(accepts)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``_NEVER`` where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge comes about across the border of each pair; with ``before`` none of a lower rank.

        A border token lives from its own merge to the merge that takes it up. Of two neighbours the one made later is
        undone first; equal tokens are made from left to right. What merges at equal rank is the leftmost pair.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x = np.full(len(a), _NEVER) if before is None else before.copy()
        until_y = until_x.copy()
        while len(at):
            rank = self.rank_of(x, y)
            bad = (rank < until_x) & (rank <= until_y) & (rank != _NEVER)
            if before is not None:
                bad &= rank < before[at]
            good[at[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry, until_x, until_y = (v[go] for v in (at, x, y, rx, ry, until_x, until_y))
            undo_x = rx > ry
            until_x, until_y = np.where(undo_x, rx, until_x), np.where(undo_x, until_y, ry)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def longest(self, symbols: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at each symbol and ends by ``end``: (token, length)."""
        token, size = np.full(len(symbols), -1, np.int64), np.zeros(len(symbols), np.int64)
        at, node, depth = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0
        while len(at):
            key = node * 512 + symbols[at + depth]
            edge = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            hit = self.edge[edge] == key
            at, node = at[hit], self.child[edge[hit]]
            depth += 1
            accept = self.accept[node]
            ends = accept >= 0
            token[at[ends]], size[at[ends]] = accept[ends], depth
            more = at + depth < end[at]
            at, node = at[more], node[more]
        return token, size

    def propose(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token, piece) of each proposed token, in order."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        ends = np.cumsum(size)
        symbols[ends - 1] += _END
        piece = np.repeat(np.arange(len(pieces)), size)
        token, length = self.longest(symbols, ends[piece])
        first = np.zeros(len(symbols), bool)
        cursor, stop = ends - size, ends
        while len(cursor):
            first[cursor] = True
            cursor = cursor + length[cursor]
            open_ = cursor < stop
            cursor, stop = cursor[open_], stop[open_]
        return token[first], piece[first]

    def exact(self, piece: bytes) -> list[int]:
        """Ids by merging the pair of lowest rank, leftmost first, until none merges."""
        table = self._dict()
        ids = [int(self.symbol_id[c]) for c in piece]
        ids[-1] = int(self.symbol_id[piece[-1] + _END])
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := table.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    pair = ids[k], ids[after[k]]
                    r = table.get(pair)
                    if r is not None:
                        heapq.heappush(heap, (r, k, *pair))
        return [t for t in ids if t >= 0]

    def exact_together(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """``exact`` for pieces of at most ``width`` symbols: in each step every piece merges its own best pair."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        symbols[np.cumsum(size) - 1] += _END
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        ids[np.arange(width + 1) < size[:, None]] = self.symbol_id[symbols]
        rank = np.full((len(pieces), width + 1), _NEVER)
        inside = np.arange(1, width + 2) < size[:, None]
        at_row, at_col = np.nonzero(inside)
        rank[inside] = self.rank_of(ids[at_row, at_col], ids[at_row, at_col + 1])
        rows = np.arange(len(pieces))
        while len(rows):
            col = rank[rows].argmin(axis=1)
            best = rank[rows, col]
            go = best != _NEVER
            rows, col, best = rows[go], col[go], best[go]
            shift = np.arange(width) > col[:, None]
            for table, last in ((ids, -1), (rank, _NEVER)):
                part = table[rows]
                part[:, :-1] = np.where(shift, part[:, 1:], part[:, :-1])
                part[:, -1] = last
                table[rows] = part
            ids[rows, col] = self.made[best]
            for k, there in ((col - 1, col > 0), (col, ids[rows, col + 1] >= 0)):
                r, c = rows[there], k[there]
                rank[r, c] = self.rank_of(ids[r, c], ids[r, c + 1])
            r, c = rows[ids[rows, col + 1] < 0], col[ids[rows, col + 1] < 0]
            rank[r, c] = _NEVER
        left = (ids >= 0).sum(axis=1)
        flat, cuts = ids[ids >= 0].tolist(), np.concatenate([[0], np.cumsum(left)]).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def exact_all(self, pieces: list[bytes]) -> list[list[int]]:
        """``exact`` of each piece, those of like length together."""
        out: list[list[int]] = [[]] * len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        kind = np.searchsorted(TOGETHER, size)
        for k, width in enumerate(TOGETHER):
            rows = np.flatnonzero(kind == k).tolist()
            if rows:
                for i, ids in zip(rows, self.exact_together([pieces[i] for i in rows], width), strict=True):
                    out[i] = ids
        for i in np.flatnonzero(kind == len(TOGETHER)).tolist():
            out[i] = self.exact(pieces[i])
        return out

    def _dict(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pairs"):
            a, b = self.left[self.made].tolist(), self.right[self.made].tolist()
            self._pairs = {pair: rank for rank, pair in enumerate(zip(a, b, strict=True))}
        return self._pairs

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece: proposed, verified, and merged exactly where a pair fails."""
        if not pieces:
            return []
        token, piece = self.propose(pieces)
        same = piece[1:] == piece[:-1]
        good = self.compatible(token[:-1][same], token[1:][same])
        failing = np.zeros(len(pieces), bool)
        failing[piece[1:][same][~good]] = True
        cuts = np.searchsorted(piece, np.arange(len(pieces) + 1)).tolist()
        tokens = token.tolist()
        out = [tokens[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        wrong = np.flatnonzero(failing).tolist()
        for k, ids in zip(wrong, self.exact_all([pieces[k] for k in wrong]), strict=True):
            out[k] = ids
        return out


class Encoder(WordIds):
    """Ids of words by ``Merges``, remembered by hash."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges = Merges(spec["model"])
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.table = {ord(c): b for c, b in byte_of.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def pieces_of(self, word: str) -> list[bytes | int]:
        """A word's pieces as bytes, and the ids of special tokens between them."""
        if word.isascii() and word.isprintable() and "<|" not in word:
            return [p.encode() for p in self._PIECES.findall(word.lower())]
        out: list[bytes | int] = []
        for part in self.cut.split(word) if self.cut else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                text = self.tokenizer.normalizer.normalize_str(part)
                cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
                out += [bytes(self.table[ord(c)] for c in piece) for piece, _ in cut]
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; pieces not met before are proposed and verified together."""
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        cut = [self.pieces_of(word) for word in words]
        new = list({p for pieces in cut for p in pieces if not isinstance(p, int) and p not in self.pieces})
        self.pieces.update(zip(new, self.merges.encode(new), strict=True))
        known = self.pieces
        return [[i for p in pieces for i in ([p] if isinstance(p, int) else known[p])] for pieces in cut]


_WORKER: dict[str, Encoder] = {}


def _path(tokenizer: str | None) -> str:
    if tokenizer is not None:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoder(tokenizer: str | None) -> Encoder:
    """The worker's encoder for a tokenizer file; by default the public one."""
    path = _path(tokenizer)
    if path not in _WORKER:
        _WORKER[path] = Encoder(path)
    return _WORKER[path]


def _with(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in docs.schema.fields if f.name != name], T.StructField(name, kind)])


def encode(docs: DataFrame, tokenizer: str | None = None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``ids``, the token ids of every whole text; ``keep_text=False`` leaves the text column out."""
    small_batches(docs.sparkSession)
    schema = _with(docs if keep_text else docs.drop(text), "ids", T.ArrayType(T.IntegerType(), False))
    names = schema.names[:-1]

    def run(batches):
        table = encoder(tokenizer)
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(text), RUN_BYTES):
                ids, counts = table.of_run(buf, off)
                ends = np.concatenate([[0], np.cumsum(counts)])
                i = 0
                while i < b - a:
                    j = max(i + 1, int(np.searchsorted(ends, ends[i] + OUT_BYTES // 4, "right")) - 1)
                    values = pa.array(ids[ends[i] : ends[j]].astype(np.int32))
                    lists = pa.ListArray.from_arrays(pa.array((ends[i : j + 1] - ends[i]).astype(np.int32)), values)
                    part = batch.slice(a + i, j - i)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], lists], names=schema.names)
                    i = j

    source = docs.select(*dict.fromkeys([*names, text]))
    return source.mapInArrow(run, schema)


def decode(
    encoded: DataFrame, tokenizer: str | None = None, ids: str = "ids", text: str = "decoded", skip_special: bool = False
) -> DataFrame:
    """``encoded`` with ``text``, the tokens of its ids joined by one space, as a tokenizer without a decoder does."""
    schema = _with(encoded, text, T.StringType())
    names = schema.names[:-1]

    def run(batches):
        with open(_path(tokenizer), encoding="utf-8") as file:
            spec = json.load(file)
        by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        if skip_special:
            for t in spec["added_tokens"]:
                if t["special"]:
                    del by_id[t["id"]]
        tokens = pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.string())
        for batch in batches:
            lists = batch.column(ids)
            lists = pc.if_else(lists.is_null(), pa.scalar([], lists.type), lists)
            size = pc.list_value_length(lists).to_numpy()
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            here = (flat >= 0) & (flat < len(tokens))
            strings = tokens.take(pa.array(np.where(here, flat, 0)))
            here &= strings.is_valid().to_numpy(zero_copy_only=False)
            kept = np.concatenate([[0], np.cumsum(here)])[np.concatenate([[0], np.cumsum(size)])]
            joined = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), strings.filter(pa.array(here)))
            out = pc.binary_join(joined, " ")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], out], names=schema.names)

    return encoded.mapInArrow(run, schema)
