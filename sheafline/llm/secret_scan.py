"""Secret scan: fixed patterns, and tokens whose characters look random rather than like an identifier.

Two first-order Markov models over characters, one of random strings and one of ordinary identifiers, are compared on
every long token by the logarithm of their likelihood ratio per character. They are counted on labelled samples: the
strings that the fixed patterns find in about ``SAMPLE_DOCS`` documents and seeded random strings of the usual
alphabets are random; the other words of those documents and joins of them by ``_``, ``-`` and case are identifiers.
The model is a table of one number per pair of characters.

Null text counts as empty. Offsets are code points, ends exclusive. Repeated rows get equal results; an empty table
gives an empty result. Other columns pass through; clashing output columns are replaced.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm.common import small_batches, stored

SAMPLE_DOCS = 2_000
#: Words of one sample document that count as identifiers, drawn by position; the sample is bounded by this.
SAMPLE_WORDS = 200
MIN_TOKEN = 20
#: Different secrets and different words of the sample that the models count at most, each kind for itself.
MAX_SECRETS = 10_000
MAX_WORDS = 10_000
#: Nats per character by which a token must be likelier under the model of random strings.
MARGIN = 1.0
#: A token of fewer different characters is filler, such as a rule of dashes.
MIN_DIFFERENT = 8

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_CODE = {c: i for i, c in enumerate(_ALPHABET + "-_=.")}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the fixed patterns; of each kind leftmost and not overlapping."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def coded(token: str) -> np.ndarray:
    """Characters as numbers."""
    return np.array([_CODE[c] for c in token], np.int64)


def transitions(tokens: list[str]) -> np.ndarray:
    """Smoothed log probabilities of the next character."""
    counts = np.full((len(_CODE), len(_CODE)), 0.5)
    for token in tokens:
        c = coded(token)
        np.add.at(counts, (c[:-1], c[1:]), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(seed: int = 11, count: int = 3_000) -> list[str]:
    """Labelled random strings of the usual alphabets."""
    rng = np.random.default_rng(seed)
    sets = (_ALPHABET[:62], _ALPHABET, "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    return ["".join(rng.choice(list(sets[i % 4]), rng.integers(20, 64))) for i in range(count)]


def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio of each pair of characters, random against ordinary."""
    small_batches(docs.sparkSession)
    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))
    sample = docs.where(F.pmod(F.xxhash64(text), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select(text)

    def label(batches):
        for batch in batches:
            kind, value = [], []
            for doc in batch.column(0).to_pylist():
                doc = doc or ""
                spans = base_spans(doc)
                strings = {doc[s:e] for s, k, e in spans if k} | {_ASSIGN.match(doc, s)[2] for s, k, _ in spans if not k}
                strings = {x for x in strings if set(x) <= _CODE.keys()}
                words = re.findall(r"[A-Za-z]{2,24}", doc)
                words = words[:: max(1, len(words) // SAMPLE_WORDS)][:SAMPLE_WORDS]
                kind += [1] * len(strings) + [0] * len(words)
                value += [*sorted(strings), *words]
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(value, pa.string())], names=["k", "v"])

    different = stored(sample.mapInArrow(label, "k int, v string").distinct(), "words")
    # Each kind has its own bound, and a hash decides what goes beyond it: secrets are rare and must not compete.
    drawn = F.xxhash64("v", F.lit("drawn"))
    kinds = [different.where(F.col("k") == k).orderBy(drawn, "v").limit(n) for k, n in ((0, MAX_WORDS), (1, MAX_SECRETS))]
    rows = kinds[0].unionByName(kinds[1]).collect()
    rng = np.random.default_rng(12)
    words = [r.v for r in rows if r.k == 0] or ["name"]
    joined = []
    for sep in ("", "_", "-", "/"):
        picks = rng.integers(0, len(words), (2_000, 4))
        joined += [
            sep.join(words[j].capitalize() if not sep else words[j].lower() for j in p[: 2 + i % 3])
            for i, p in enumerate(picks)
        ]
    joined += [f"{words[i]}{n}" for i, n in zip(rng.integers(0, len(words), 500), rng.integers(0, 3000, 500), strict=True)]
    randoms = random_strings() + [r.v for r in rows if r.k == 1]
    return transitions(randoms) - transitions(joined + words)


def all_spans(text: str, ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and random-looking tokens that none of them touches."""
    found = base_spans(text)
    taken = [(s, e) for s, _, e in found]
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        if len(set(m.group())) < MIN_DIFFERENT or any(a < e and s < b for a, b in taken):
            continue
        c = coded(m.group())
        if ratio[c[:-1], c[1:]].mean() >= MARGIN:
            found.append((s, 3, e))
    return sorted(found)


def rendered(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, joined by commas."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_OUT = ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")


def scan(docs: DataFrame, ratio: np.ndarray, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with counts per kind, the digest of the base spans and all spans."""
    columns = [c for c in docs.columns if c not in _OUT]
    fields = [f for f in docs.select(*columns).schema.fields if keep_text or f.name != text]
    schema = T.StructType(list(fields))
    for name in _OUT[:4]:
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_sha256", T.StringType()).add("spans", T.StringType())

    def run(batches):
        for batch in batches:
            counts, digests, spans = [], [], []
            for value in batch.column(text):
                found = all_spans(value.as_py() or "", ratio)
                counts.append([sum(1 for x in found if x[1] == k) for k in range(4)])
                base = rendered([x for x in found if x[1] < 3])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(rendered(found))
            kept = [batch.column(f.name) for f in fields]
            totals = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            texts = [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays([*kept, *totals, *texts], names=schema.names)

    return docs.select(*columns).mapInArrow(run, schema)


def redact(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[secret]``; touching and overlapping spans by one."""
    columns = docs.columns

    def run(batches):
        for batch in batches:
            clean = []
            for value in batch.column(text):
                value = value.as_py()
                out, at = [], 0
                for s, _, e in all_spans(value or "", ratio):
                    if e > at:
                        if s >= at:
                            out += [value[at:s], "[secret]"]
                        at = e
                clean.append(value if not out else "".join([*out, value[at:]]))
            kept = [pa.array(clean, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(kept, names=columns)

    return docs.mapInArrow(run, docs.schema)
