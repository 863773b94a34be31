"""Speculative BPE encoding against the tokenizers library, and awkward inputs."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import awkward, empty
from tokenizers import Tokenizer

from sheafline.llm import bpe
from sheafline.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def table():
    return bpe.Encoder(PATH)


def library(words):
    return [e.ids for e in LIBRARY.encode_batch(words, add_special_tokens=False)]


def test_words_of_every_kind(table):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeilnorstaaa") for _ in range(rng.randint(1, 90))) for _ in range(20_000)]
    words += [unit * k for unit in ("a", "ab", "!", "-=", "é", "日本", "na") for k in (1, 2, 3, 7, 31, 64, 65, 400)]
    words += ["x<|endoftext|>y", "<|endoftext|>", "<|endoftext|", "<|startoftext|><|endoftext|>", "İstanbul", "ΣΑΣ", "it's", "a\x00b"]
    assert table.encode(words) == library(words)


@given(st.text(min_size=1, max_size=30).filter(lambda w: w.split() == [w]))
@settings(max_examples=300, deadline=None)
def test_any_word(table, word):
    assert table.encode([word]) == library([word])


def test_check_is_exact(table):
    """A proposal passes exactly if it is what merging gives; both ways of merging agree."""
    rng = random.Random(4)
    pieces = [bytes(rng.choice(b"aeinorst") for _ in range(rng.randint(2, 30))) for _ in range(3_000)]
    merges = table.merges
    token, piece = merges.propose(pieces)
    same = piece[1:] == piece[:-1]
    good = merges.compatible(token[:-1][same], token[1:][same])
    failing = np.zeros(len(pieces), bool)
    failing[piece[1:][same][~good]] = True
    exact = [merges.exact(p) for p in pieces]
    proposed = [token[piece == k].tolist() for k in range(len(pieces))]
    assert [a != b for a, b in zip(proposed, exact, strict=True)] == failing.tolist()
    assert 0 < failing.sum() < len(pieces)
    assert merges.exact_all(pieces) == exact


def test_query_agrees_with_the_library(spark, sf_dir):
    import hashlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    encoded = LIBRARY.encode_batch([r.text or "" for r in docs], add_special_tokens=False)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {
        (r.doc_id, len(e.ids), digest(" ".join(map(str, e.ids))), digest(LIBRARY.decode(e.ids, skip_special_tokens=False)))
        for r, e in zip(docs, encoded, strict=True)
    }
    assert {tuple(r) for r in QUERIES["op13_bpe_round_trip"](spark, sf_dir).collect()} == want


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = bpe.decode(bpe.encode(docs)).collect()
    texts = [r.text or "" for r in rows]
    assert [r.ids for r in rows] == library(texts)
    assert [r.decoded for r in rows] == [LIBRARY.decode(i, skip_special_tokens=False) for i in library(texts)]
    assert len(rows) == 9 and "score" in rows[0]
    assert bpe.decode(bpe.encode(empty(spark))).collect() == []


def test_decode_ids_of_any_kind(spark):
    given_ids = [[49406, 320, None, 49407], None, [], [-5, 70_000, 0]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given_ids)], "k int, ids array<int>")
    plain = [r.decoded for r in bpe.decode(rows).orderBy("k").collect()]
    assert plain == ["<|startoftext|> a</w> <|endoftext|>", "", "", "!"]
    assert bpe.decode(rows, skip_special=True).orderBy("k").first().decoded == "a</w>"
