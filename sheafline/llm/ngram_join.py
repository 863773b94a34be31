"""N-gram Jaccard join: prefix-tree matching of globally ordered shingle sets.

A document's set holds the 64-bit hashes (one bit dropped) of its distinct five-word shingles, in hash order. Equal
sets are one class. Two sets of at least 80 per cent similarity share a token among the first fifth of each, so those
tokens are posted once per class and sorted by token:

1. Classes that share a token held by at most ``GROUP`` classes are paired; the holders of a commoner token are only
   linked to the smallest of them. The shared tokens of a pair are counted, and the pair is dropped if even all
   remaining tokens could not make up the overlap it needs. What is left is matched in a prefix tree (``Trie``).
2. Common tokens whose holders are not all connected by then: for their holders these tokens are moved to the end of
   the global order, new first fifths are posted, and step 1 is repeated, as long as that settles documents. A
   document that merely contains popular passages soon posts its own tokens only. Tokens that many neighbouring rows
   share are moved in the first round already.
3. Holders of tokens that are still common and not connected consist of common text. They form families; the members
   outside a family's largest component are matched in prefix trees against blocks of the whole family.

Every step is exact: no partner, candidate or group is cut off. Pairs inside one component need not be compared, since
the result is the components; so a group of n near copies costs about n rows, not n squared.

Null text and texts without a word have empty sets and link with nothing. Shorter texts have their whole word sequence
as one shingle. ``doc_id`` is a whole number; other types are refused. Where it is null or repeated the rows get keys of
their own: rows that share a ``doc_id`` are one node, whatever their texts, rows without one are nodes, and a component
is named by its smallest ``doc_id`` (null if it has none, and for rows without ``doc_id``). Repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import BROADCAST_IDS, discard, matching, release, small_batches, stored
from sheafline.llm.components import components

WORDS = 5
PERCENT = 80
#: Holders of one token that are paired with each other; beyond it they are linked to one of them.
GROUP = 32
#: Tokens of neighbouring sets that are counted at once.
COUNT_TOKENS = 1 << 20
#: Partners of one class, or members of one block, in a tree.
CHUNK = 256
BLOCK = 512
#: Step 2 is repeated while it leaves at most this share of the documents it began with.
SHRINK = 0.7

_ODD = np.random.default_rng(5).integers(1, 2**62, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def needed(a, b, percent: int = PERCENT):
    """Shared tokens that sets of sizes a and b need."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n, percent: int = PERCENT):
    """Tokens of a set of size n of which every partner holds one."""
    return n + (percent * -n) // 100 + 1


def shingles(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text in ascending order, all texts in one array, and how many each has."""
    starts, ends, row = tb.spans(tb.GAP[buf], off)
    rows = len(off) - 1
    h = tb.hashed(tb.LOWER[buf], starts, ends)
    count = np.bincount(row, minlength=rows)
    windows = max(len(h) - words + 1, 0)
    total = np.zeros(windows, np.uint64)
    for k in range(words):
        total += h[k : k + windows] * _ODD[k]
    inside = row[:windows] == row[words - 1 : words - 1 + windows]
    token, owner = tb.mixed(total[inside]), row[:windows][inside]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.searchsorted(row, short)
        extra = [
            np.append(h[f : f + c] * _ODD[:c], _ODD[words] ^ np.uint64(c)).sum(dtype=np.uint64)
            for f, c in zip(first, count[short], strict=True)
        ]
        token = np.concatenate([token, tb.mixed(np.array(extra, np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        token, owner = token[order], owner[order]
    token = (token >> np.uint64(1)).astype(np.int64)
    cut = np.searchsorted(owner, np.arange(rows + 1))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        token[a:b].sort()
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    return token[fresh], np.bincount(owner[fresh], minlength=rows)


def _binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _tokens(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int64)


def _digests(percent: int):
    """(doc_id, text) -> doc_id, n, a digest of the set in two numbers, and the tokens of which a partner holds one."""

    def run(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(1)):
                token, n = shingles(buf, off)
                ends, sums = np.cumsum(n), []
                for salt in (1, 2):
                    at = np.zeros(len(token) + 1, np.uint64)
                    np.cumsum(tb.mixed(token.astype(np.uint64) + _ODD[salt]), out=at[1:])
                    sums.append(pa.array((at[ends] - at[ends - n]).view(np.int64)))
                first = np.where(n > 0, prefix_size(n, percent), 0)
                parts = _binary([token[e - c : e - c + p] for e, c, p in zip(ends, n, first, strict=True)])
                own = [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*own, *sums, parts], names=["doc_id", "n", "s1", "s2", "prefix"])

    return run


def _sets(batches):
    """(doc_id, text) -> id, n, tokens."""
    for batch in batches:
        for a, b, buf, off in tb.runs(batch.column(1)):
            token, n = shingles(buf, off)
            ends = np.cumsum(n)
            parts = _binary([token[e - c : e] for e, c in zip(ends, n, strict=True)])
            own = [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*own, parts], names=["id", "n", "tokens"])


def _postings(batches):
    """(id, n, tokens) -> token, id, n for every token."""
    for batch in batches:
        lists = [_tokens(v) for v in batch.column(2)]
        counts = [len(v) for v in lists]
        token = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        ids = np.repeat(batch.column(0).to_numpy(), counts)
        n = np.repeat(batch.column(1).to_numpy(), counts).astype(np.int32)
        for a in range(0, len(token), 1 << 18):
            part = slice(a, a + (1 << 18))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[part]), pa.array(ids[part]), pa.array(n[part])], names=["token", "id", "n"]
            )


_POSTING = "token bigint, id bigint, n int"
_SET = "id bigint, n bigint, tokens binary"


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)


def _pairs_of(token, ids, n, percent):
    """Pairs within complete groups of at most GROUP holders; rows are sorted by token, then size."""
    begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    size = np.diff(np.r_[begin, len(token)])
    left, right = [], []
    for g in np.unique(size[size > 1]):
        i, j = np.triu_indices(int(g), 1)
        at = begin[size == g][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    if not left:
        return None
    a, b = np.concatenate(left), np.concatenate(right)
    near = (100 * n[a].astype(np.int64) >= percent * n[b].astype(np.int64)) & (ids[a] != ids[b])
    a, b = a[near], b[near]
    return ids[a], ids[b], n[a], n[b], np.zeros(len(a), np.int64), np.zeros(len(a), bool)


_FOUND = "a bigint, b bigint, na int, nb int, token bigint, common boolean"


def paired(postings: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidate pairs, and the holders of common tokens (``common``: a holds ``token``; b is the smallest holder)."""

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "na", "nb", "token", "common"])

    def run(batches):
        carry = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        open_token, pivot, pivot_n = None, 0, 0

        def common(t, i, n):
            """Rows of one common token."""
            size = len(i)
            return i, np.full(size, pivot), n, np.full(size, pivot_n, np.int32), t, np.ones(size, bool)

        for batch in batches:
            token, ids, n = (np.concatenate([c, batch.column(k).to_numpy()]) for k, c in enumerate(carry))
            if open_token is not None and len(token):
                upto = int(np.searchsorted(token, open_token, "right"))
                if upto:
                    yield batch_of(common(token[:upto], ids[:upto], n[:upto]))
                token, ids, n = token[upto:], ids[upto:], n[upto:]
                if len(token):
                    open_token = None
            if not len(token):
                carry = [token, ids, n]
                continue
            begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            size = np.diff(np.r_[begin, len(token)])
            for k in np.flatnonzero(size > GROUP):
                part = slice(begin[k], begin[k] + size[k])
                pivot, pivot_n = ids[begin[k]], n[begin[k]]
                yield batch_of(common(token[part], ids[part], n[part]))
            last = begin[-1]
            small = np.repeat(size <= GROUP, size)
            if size[-1] > GROUP:
                open_token, carry = token[last], [token[:0], ids[:0], n[:0]]
            else:
                carry = [token[last:], ids[last:], n[last:]]
                small[last:] = False
            found = _pairs_of(token[small], ids[small], n[small], percent) if small.any() else None
            if found is not None:
                yield batch_of(found)
        if len(carry[0]) > 1:
            found = _pairs_of(*carry, percent)
            if found is not None:
                yield batch_of(found)

    ordered = postings.repartition("token").sortWithinPartitions("token", "n", "id")
    return ordered.mapInArrow(run, _FOUND)


def promising(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose counted overlap can still reach what they need."""
    common = found.where("common").groupBy("a").agg(F.count(F.lit(1)).alias("hidden"))
    pairs = found.where("a <> b").select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.greatest("na", "nb").cast("bigint").alias("high"),
        F.least("na", "nb").cast("bigint").alias("low"),
    )
    counted = pairs.where(100 * F.col("low") >= percent * F.col("high")).groupBy("a", "b", "low", "high")
    counted = counted.agg(F.count(F.lit(1)).alias("seen")).join(common, "a", "left")
    rest = F.ceil(F.lit(percent) * F.col("high") / 100) - 1
    need = F.ceil(F.lit(percent) * (F.col("low") + F.col("high")) / (100 + percent))
    return counted.where(F.col("seen") + F.coalesce("hidden", F.lit(0)) + rest >= need).select("a", "b").distinct()


class Trie:
    """A path-compressed prefix tree of sorted token arrays."""

    def __init__(self, sets: list[tuple[int, np.ndarray]]):
        sets = sorted(sets, key=lambda s: s[1].astype(">i8").tobytes())
        self.sets = sets
        self.segment: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.ends: list[list[int]] = []
        self.smallest: list[int] = []
        self.below: list[int] = []
        todo = [(0, len(sets), 0, -1)] if sets else []
        while todo:
            low, high, depth, parent = todo.pop()
            first, last = sets[low][1], sets[high - 1][1]
            reach = min(len(first), len(last))
            differs = np.flatnonzero(first[depth:reach] != last[depth:reach])
            end = depth + int(differs[0]) if len(differs) else reach
            node = len(self.segment)
            if parent >= 0:
                self.children[parent].append(node)
            self.segment.append(first[depth:end])
            self.children.append([])
            sizes = [len(s[1]) for s in sets[low:high]]
            self.smallest.append(min(sizes))
            self.below.append(max(sizes) - end)
            i = low
            while i < high and len(sets[i][1]) == end:
                i += 1
            self.ends.append(list(range(low, i)))
            while i < high:
                j = i + 1
                while j < high and sets[j][1][end] == sets[i][1][end]:
                    j += 1
                todo.append((i, j, end, node))
                i = j

    def matches(self, tokens: np.ndarray, percent: int = PERCENT) -> list[int]:
        """Ids of the sets that are similar enough to ``tokens``; the overlap of a shared path is taken once."""
        found, size = [], len(tokens)
        todo = [(0, 0, 0)] if self.segment else []
        while todo:
            node, overlap, at = todo.pop()
            segment = self.segment[node]
            if len(segment):
                place = np.searchsorted(tokens, segment)
                inside = place < size
                overlap += int((tokens[place[inside]] == segment[inside]).sum())
                at = int(np.searchsorted(tokens, segment[-1], "right"))
            if overlap + min(self.below[node], size - at) < needed(size, self.smallest[node], percent):
                continue
            for i in self.ends[node]:
                if overlap >= needed(size, len(self.sets[i][1]), percent):
                    found.append(self.sets[i][0])
            todo += [(child, overlap, at) for child in self.children[node]]
        return found


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links among candidate pairs: each ``a`` runs through a tree of up to ``CHUNK`` of its partners."""
    count = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunked = pairs.join(count, "a").withColumn("k", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
    partners = chunked.select("a", "k", F.lit(1).alias("side"), F.col("b").alias("id"))
    probes = chunked.select("a", "k").distinct().select("a", "k", F.lit(0).alias("side"), F.col("a").alias("id"))
    return matched(partners.unionByName(probes).join(sets.select("id", "tokens"), "id"), ["a", "k"], percent)


def matched(rows: DataFrame, keys: list[str], percent: int = PERCENT) -> DataFrame:
    """Links between the probes (side 0) and the sets (side 1) of each key; a key holds a bounded number of both.

    Links inside what a key has already connected are left out: the result is the components.
    """

    def links(probes, targets):
        """Of the links found, those that connect something: fewer than there are probes and sets."""
        trie, root, out = Trie(targets), {}, []

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for i, tokens in probes:
            for j in trie.matches(tokens, percent):
                a, b = find(i), find(j)
                if a != b:
                    root[a] = b
                    out.append((i, j))
        return out

    def run(batches):
        key, probes, targets = None, [], []
        for batch in batches:
            out = []
            names = list(zip(*[batch.column(c).to_pylist() for c in keys], strict=True))
            sides, ids, tokens = (batch.column(c) for c in ("side", "id", "tokens"))
            for r, name in enumerate(names):
                if name != key:
                    out += links(probes, targets) if probes and targets else []
                    key, probes, targets = name, [], []
                item = (ids[r].as_py(), np.frombuffer(tokens[r].as_py(), np.int64))
                (targets if sides[r].as_py() else probes).append(item)
            if out:
                yield _links(out)
        if probes and targets:
            yield _links(links(probes, targets))

    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "side")
    return ordered.select(*keys, "side", "id", "tokens").mapInArrow(run, "a bigint, b bigint")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def unsettled(found: DataFrame, groups: DataFrame) -> DataFrame:
    """Holders (token, id, pivot, component) of common tokens that join more than one component."""
    held = found.where("common").select("token", F.col("a").alias("id"), F.col("b").alias("pivot"))
    held = held.join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    held = held.withColumn("component", F.coalesce("component", "id"))
    mixed = held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return held.join(mixed.select("token"), "token", "left_semi")


def _firsts(batch, lists, lates, percent):
    """First fifths of token lists when those in ``lates`` come last."""
    parts = []
    for tokens, late in zip(lists, lates, strict=True):
        order = np.concatenate([tokens[~late], tokens[late]])
        parts.append(order[: prefix_size(len(tokens), percent)])
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(parts)], names=["id", "n", "prefix"])


def reposted(docs: DataFrame, text: str, moved: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Postings of the first fifths of ``docs`` when the tokens in the table ``moved`` come last in the order.

    Up to ``BROADCAST_IDS`` moved tokens go to every task; more are joined to the sets' tokens by shuffle. Steps that
    follow each other without a shuffle share one Python worker.
    """
    if moved.count() <= BROADCAST_IDS:
        shared = docs.sparkSession.sparkContext.broadcast(np.sort(moved.toArrow().column("token").to_numpy()))

        def known(batches):
            for batch in batches:
                lists = [_tokens(v) for v in batch.column(2)]
                ends = np.cumsum([len(v) for v in lists])
                late = np.isin(np.concatenate(lists), shared.value) if lists else np.zeros(0, bool)
                yield _firsts(batch, lists, [late[e - len(v) : e] for e, v in zip(ends, lists, strict=True)], percent)

        return _texts(docs, text).mapInArrow(lambda batches: _postings(known(_sets(batches))), _POSTING)

    sets = _texts(docs, text).mapInArrow(_sets, _SET)
    every = _texts(docs, text).mapInArrow(lambda batches: _postings(_sets(batches)), _POSTING)
    late = every.join(moved, "token").groupBy("id").agg(F.collect_set("token").alias("late"))

    def joined(batches):
        for batch in batches:
            lists = [_tokens(v) for v in batch.column(2)]
            lates = [np.isin(t, np.array(v.as_py() or [], np.int64)) for t, v in zip(lists, batch.column(3), strict=True)]
            yield _firsts(batch, lists, lates, percent)

    return (
        sets.join(late, "id", "left")
        .select("id", "n", "tokens", "late")
        .mapInArrow(lambda batches: _postings(joined(batches)), _POSTING)
    )


def _repeated(batches):
    """(id, n, tokens) -> token, count of the tokens that several sets of the same ``COUNT_TOKENS`` hold."""
    lists, size = [], 0

    def counted():
        token, count = np.unique(np.concatenate(lists), return_counts=True)
        more = count > 1
        return pa.RecordBatch.from_arrays([pa.array(token[more]), pa.array(count[more])], names=["token", "count"])

    for batch in batches:
        for value in batch.column(2):
            lists.append(_tokens(value))
            size += len(lists[-1])
        if size > COUNT_TOKENS:
            yield counted()
            lists, size = [], 0
    if lists:
        yield counted()


def likely_common(docs: DataFrame, text: str) -> DataFrame:
    """Tokens that are common among ``docs``, judged by stretches of neighbouring rows.

    Which tokens are moved decides how soon documents settle, not what is linked; so a token whose few holders lie far
    apart may be missed here, and a later round finds it.
    """
    counts = _texts(docs, text).mapInArrow(lambda batches: _repeated(_sets(batches)), "token bigint, count bigint")
    return counts.groupBy("token").agg(F.sum("count").alias("holders")).where(F.col("holders") > GROUP).select("token")


def family_links(held: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links of the members outside a family's largest component to any member."""
    family = components(held.select(F.col("id").alias("a"), F.col("pivot").alias("b")))
    family = family.select(F.col("node").alias("id"), F.col("component").alias("family"))
    members = stored(held.select("id", "component").distinct().join(family, "id"), "family")
    shares = members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = shares.groupBy("family").agg(
        F.max_by("component", F.struct("m", "component")).alias("largest"),
        F.ceil(F.sum("m") / BLOCK).cast("int").alias("blocks"),
    )
    marked = members.join(largest, "family").withColumn("outside", F.col("component") != F.col("largest"))
    strays = marked.where("outside").groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    marked = marked.join(strays, "family")
    own = lambda salt, count: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    targets = marked.select("family", every("parts").alias("i"), own("target", "blocks").alias("j"), F.lit(1).alias("side"), "id")
    probes = marked.where("outside").select(
        "family", own("probe", "parts").alias("i"), every("blocks").alias("j"), F.lit(0).alias("side"), "id"
    )
    rows = targets.unionByName(probes).join(sets.select("id", "tokens"), "id")
    return matched(rows, ["family", "i", "j"], percent)


def classes(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, s1, s2) of every row, and (s1, s2, id, n, prefix) of every class of equal non-empty sets."""
    small_batches(docs.sparkSession)
    digested = "doc_id bigint, n bigint, s1 bigint, s2 bigint, prefix binary"
    wide = stored(_texts(docs, text).mapInArrow(_digests(percent), digested), "sets")
    grouped = wide.where("n > 0").groupBy("s1", "s2", "n")
    kinds = stored(grouped.agg(F.min("doc_id").alias("id"), F.min_by("prefix", "doc_id").alias("prefix")), "classes")
    rows = stored(wide.select("doc_id", "n", "s1", "s2"), "rows")
    discard(wide)
    return rows, kinds


def groups_of(docs: DataFrame, kinds: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(node, component) of every class that has a link. The table ``kinds`` is used up: its prefixes are needed once."""
    small_batches(docs.sparkSession)

    def narrowed(found: DataFrame) -> DataFrame:
        """What is needed of ``found`` once its pairs are counted: the holders of common tokens."""
        common = stored(found.where("common"), "common")
        discard(found)
        return common

    first = kinds.select("id", "n", "prefix").mapInArrow(_postings, _POSTING)
    found = stored(paired(first, percent), "pairs")
    discard(kinds)
    release()
    pairs = stored(promising(found, percent), "pairs")
    found = narrowed(found)

    def named(ids: DataFrame) -> DataFrame:
        """Documents of the given classes."""
        return matching(docs, stored(ids.distinct(), "ids").withColumnRenamed("id", "doc_id"), "doc_id")

    def fetched(ids: DataFrame) -> DataFrame:
        """Sets of the given classes, made again from the texts: kept, they would be larger than those."""
        return _texts(named(ids), text).mapInArrow(_sets, _SET)

    def settled(groups: DataFrame) -> DataFrame:
        """What earlier links come to: one link per node."""
        return groups.select(F.col("node").alias("a"), F.col("component").alias("b"))

    def ends_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))

    links = stored(verified(pairs, fetched(ends_of(pairs)), percent), "links")
    discard(pairs)
    release()
    groups = components(links)
    discard(links)
    before, moved = None, None
    while True:
        held = stored(unsettled(found, groups), "held")
        ids = stored(held.select("id").distinct(), "ids")
        left = ids.count()
        if not left:
            return groups
        if before is not None and left > SHRINK * before:
            return components(settled(groups).unionByName(stored(family_links(held, fetched(ids), percent), "links")))
        before = left
        known = likely_common(named(ids), text) if moved is None else moved
        moved = stored(known.unionByName(held.select("token")).distinct(), "moved")
        discard(found)
        found = stored(paired(reposted(named(ids), text, moved, percent), percent), "pairs")
        discard(held)
        release()
        pairs = stored(promising(found, percent), "pairs")
        found = narrowed(found)
        links = stored(verified(pairs, fetched(ends_of(pairs)), percent), "links")
        discard(pairs)
        release()
        groups = components(settled(groups).unionByName(links))
        discard(links)


def components_of(docs: DataFrame, text: str, percent: int, same: DataFrame | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; ids are unique, ``same`` holds pairs (a, b) of ids to link."""
    rows, kinds = classes(docs, text, percent)
    names = stored(kinds.select("s1", "s2", "n", "id"), "names")
    groups = groups_of(docs, kinds, text, percent)
    if same is not None:
        owner = rows.join(names, ["s1", "s2", "n"]).select("doc_id", "id")
        ends = same.join(owner.withColumnsRenamed({"doc_id": "a", "id": "ka"}), "a")
        ends = ends.join(owner.withColumnsRenamed({"doc_id": "b", "id": "kb"}), "b").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
        groups = components(ends.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = names.join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("s1", "s2", "n", F.coalesce("component", "id").alias("component"))
    return rows.join(named, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


_KEY = "__row"


def _keyed(docs: DataFrame) -> DataFrame | None:
    """None if every row has a ``doc_id`` of its own; else the rows with a key, written so that the key stays."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"doc_id must be a whole number, not {kind.simpleString()}")
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if counted.where("n > 1 or doc_id is null").isEmpty():
        return None
    return stored(docs.withColumn(_KEY, F.monotonically_increasing_id()), "keyed")


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    keyed = _keyed(docs.select("doc_id", text))
    if keyed is None:
        return components_of(docs, text, percent)
    ids = keyed.select(_KEY, "doc_id")
    firsts = ids.where("doc_id is not null").groupBy("doc_id").agg(F.min(_KEY).alias("b"))
    same = ids.join(firsts, "doc_id").where(F.col(_KEY) != F.col("b")).select(F.col(_KEY).alias("a"), "b")
    found = components_of(keyed.select(F.col(_KEY).alias("doc_id"), text), text, percent, same)
    found = stored(ids.join(found.withColumnRenamed("doc_id", _KEY), _KEY), "found")
    names = found.groupBy("component_id").agg(F.min("doc_id").alias("name"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("name"))
    return found.join(names, "component_id").select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest ``doc_id``; rows without words stay.

    Rows count by their texts: rows that share a ``doc_id`` but not a text are compared like any others.
    """
    keyed = _keyed(docs)
    if keyed is None:
        found = components_of(docs, text, percent)
        dropped = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "dropped")
        return matching(docs, dropped, "doc_id", "left_anti")
    found = components_of(keyed.select(F.col(_KEY).alias("doc_id"), text), text, percent).where("n_shingles > 0")
    found = stored(found.withColumnRenamed("doc_id", _KEY).join(keyed.select(_KEY, "doc_id"), _KEY), "found")
    first = F.min_by(_KEY, F.struct(F.col("doc_id").isNull(), "doc_id", _KEY)).alias("first")
    firsts = found.groupBy("component_id").agg(first)
    dropped = stored(found.join(firsts, "component_id").where(F.col(_KEY) != F.col("first")).select(_KEY), "dropped")
    return matching(keyed, dropped, _KEY, "left_anti").drop(_KEY)
