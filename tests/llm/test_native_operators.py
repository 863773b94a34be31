"""Rules, licences, chat windows and the mix: brute force and awkward rows."""

import hashlib
import random
import re
import textwrap
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import PROSE, awkward, empty

from sheafline.llm import chat, license_scan, mixing, rules

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    w = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[t] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rule_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("a b c dd # é x\n y\n\n".split(" ")) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in rules.base_counts(docs).collect():
        assert tuple(r[c] for c in rules.COUNTS) == counts(texts[r.doc_id])


def test_cascade_verdict_does_not_depend_on_order(spark):
    docs = rules.base_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    given = rules.default_rules()
    first = {(r.doc_id, r.kept) for r in rules.cascade(docs, given).select("doc_id", "kept").collect()}
    last = {(r.doc_id, r.kept) for r in rules.cascade(docs, given[::-1]).select("doc_id", "kept").collect()}
    assert first == last
    assert {r.name for r in rules.ordered(docs, given)} == {r.name for r in given}


def test_long_texts_may_not_repeat_lines_as_short_ones_may(spark):
    line = lambda k: " ".join(f"word{k}x{i} and" for i in range(5))
    long_, short = [line(0 if k < 45 else k) for k in range(100)], [line(0 if k < 3 else k) for k in range(6)]
    docs = spark.createDataFrame([(1, "\n".join(long_)), (2, "\n".join(short))], "doc_id bigint, text string")
    verdicts = {r.doc_id: (r.base_failed, r.kept) for r in rules.apply_rules(docs).collect()}
    assert verdicts == {1: (False, False), 2: (False, True)}


def test_costly_rules_reject_and_run_on_survivors_only(spark):
    prose = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} and" for i in range(40))
    texts = {
        1: prose,
        2: " ".join(f"{i}{i}{i} of" for i in range(100, 140)),
        3: " ".join(f"({i}) -- x{i}" for i in "abcdefghijklmnopqrstuvwxyz"[:20]) + " ;; ??" * 30,
        4: "\n\n".join([prose, "alpha beta gamma", "alpha beta gamma", "alpha beta gamma", "alpha beta gamma"]),
    }
    docs = rules.base_counts(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    by_name = {r.name: r for r in rules.default_rules()}
    for name, wanted in (("figures", {2}), ("repeated_paragraphs", {4})):
        kept = {r.doc_id for r in rules.cascade(docs, [by_name[name]]).where("kept").collect()}
        assert kept == set(texts) - wanted
    assert 3 not in {r.doc_id for r in rules.cascade(docs, [by_name["no_letters"]]).where("kept").collect()}
    # What a later rule needs is never computed for a row that an earlier one has rejected.
    trap = rules.Rule("trap", F.col("__t") == 1, {"__t": F.when(F.col("doc_id") == 2, F.raise_error(F.lit("computed")).cast("int")).otherwise(0)})
    assert rules.cascade(docs, [by_name["figures"], trap]).where("kept").count() == 3


def test_rules_take_awkward_rows(spark):
    out = rules.apply_rules(awkward(spark))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == 9 and rows[1].kept and not rows[2].kept and rows[3].n_words == 0 and rows[4].n_dup_lines == 0
    assert rules.apply_rules(empty(spark)).collect() == []


def test_licences(spark):
    rows = [
        (1, "src/LICENSE", "Released under the MIT License."),
        (2, "src/a/b/c.txt", PROSE),
        (3, "src/a/d.txt", PROSE * 3 + "\nLicensed under the Apache License, Version 2.0."),
        (4, "other/x.txt", PROSE),
        (5, None, None),
        (6, "src/a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (7, "src/a/b/e.txt", ""),
        (8, "z.txt", "a licence for fishing in the lake was given to the old man by the mayor of the town last year"),
        (8, "z.txt", "a licence for fishing in the lake was given to the old man by the mayor of the town last year"),
    ]
    files = spark.createDataFrame([(*r, "x") for r in rows], "id int, path string, text string, license string")
    out = license_scan.scan(files, "id", F.col("path"))
    got = {r.id: (r.license, r.inherited, r.inherited_from) for r in out.collect()}
    assert out.count() == 9
    assert got[1] == ("MIT", None, None) and got[3] == ("Apache-2.0", None, None)
    assert got[2] == got[7] == (None, "GPL-3.0", "src/a")
    assert got[4] == got[5] == got[8] == (None, None, None)
    assert license_scan.scan(files.limit(0), "id", F.col("path")).collect() == []


def licence_text(name, width=70):
    """A full licence text under another holder, wrapped at another width."""
    text = (Path(license_scan.__file__).with_name("licences") / f"{name}.txt").read_text()
    text = text.replace("<year> <copyright holders>", "2019 Jane Roe").replace("The Regents of the University of California", "Jane Roe 2019")
    return "\n\n".join(textwrap.fill(p, width) for p in re.split(r"\n\s*\n", text))


def test_whole_licence_texts_are_licence_files(spark):
    names = ["MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-3.0", "ISC"]
    rows = [(n, f"{n}/{file}", licence_text(n)) for n, file in zip(names, ["LICENSE", "x.txt", "COPYING", "LICENSE.md", "COPYING", "y", "z"], strict=True)]
    rows += [(f"below {n}", f"{n}/src/deep/a.txt", PROSE) for n in names]
    rows += [
        ("named", "named/NOTICE", f"{PROSE}\nReleased under the MIT License.\n{PROSE}"),
        ("below named", "named/a.txt", PROSE),
        ("code", "code/license_scan.py", f"{PROSE}\nReleased under the MIT License.\n{PROSE}"),
        ("below code", "code/a.txt", PROSE),
        ("short", "short/a.txt", "Released under the MIT License."),
        ("below short", "short/b.txt", PROSE),
    ]
    files = spark.createDataFrame(rows, "id string, path string, text string")
    got = {r.id: r for r in license_scan.scan(files, "id", F.col("path")).collect()}
    assert {n: got[n].license for n in names} == {n: n for n in names}
    assert {n: (got[f"below {n}"].inherited, got[f"below {n}"].inherited_from) for n in names} == {n: (n, n) for n in names}
    assert got["below named"].inherited == "MIT" and got["below code"].inherited is None
    assert got["below short"].inherited is None
    stand_in = license_scan.scan(files, "id", F.col("path"), short_words=60)
    assert {r.id: r for r in stand_in.collect()}["below short"].inherited == "MIT"


GPL_2 = """/* Frob, a tool.
 * Copyright (C) 2001 Jane Roe
 *
 * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 */
int main(void) { return 0; }
"""
APACHE = """#!/bin/sh
# Copyright 2020 Jane Roe
#
# Licensed under the Apache License,
# Version 2.0 (the "License"); you may not use this file except in
# compliance with the License. You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
echo done
"""


def test_headers_are_read_as_blocks_and_need_name_and_version(spark):
    comment = lambda name: "".join(f"// {x}\n" for x in licence_text(name).split("\n")) + "let x = 1;\n" * 400
    want = {
        GPL_2: "GPL-2.0",
        GPL_2.replace("version 2", "version 3"): "GPL-3.0",
        GPL_2.replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1"): "LGPL-2.1",
        GPL_2.replace("version 2", "version 9"): None,
        GPL_2.replace(" * ", "").replace("/* Frob", "/*\nFrob"): "GPL-2.0",
        APACHE: "Apache-2.0",
        comment("MIT"): "MIT",
        comment("BSD-3-Clause").replace("Copyright (c) Jane Roe 2019.", ""): "BSD-3-Clause",
        comment("ISC"): "ISC",
        "// SPDX-License-Identifier: GPL-2.0": "GPL-2.0",
        "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;": "GPL-2.0",
        "// SPDX-License-Identifier: EPL-2.0": None,
        "// SPDX-License-Identifier: MIT-0": None,
        "# SPDX-License-Identifier: MIT": "MIT",
        "Licensed under the Foo License, Version 2.0": None,
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    files = spark.createDataFrame([(k, f"{k}/x", t) for k, t in enumerate(want)], "id int, path string, text string")
    got = {r.id: r.license for r in license_scan.scan(files, "id", F.col("path")).collect()}
    assert got == dict(enumerate(want.values()))


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_every_licence_of_an_expression(spark):
    texts = {
        "a.c": "// SPDX-License-Identifier: MIT OR Apache-2.0\nint a;",
        "b.c": "/* SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND BSD-3-Clause */\nint b;",
        "c.py": "# SPDX-License-Identifier: MPL-2.0\nx = 1",
        "d.py": "# SPDX-License-Identifier: Foo-1.0 OR Bar\nx = 1",
        "e.py": None,
    }
    files = spark.createDataFrame([(p, t, [1]) for p, t in texts.items()], "path string, text string, licenses array<int>")
    got = {r.path: (r.license, r.licenses) for r in license_scan.scan(files, "path", F.col("path")).collect()}
    assert got == {
        "a.c": ("Apache-2.0", ["Apache-2.0", "MIT"]),
        "b.c": ("BSD-3-Clause", ["BSD-3-Clause", "GPL-2.0"]),
        "c.py": ("MPL-2.0", ["MPL-2.0"]),
        "d.py": (None, []),
        "e.py": (None, []),
    }


def test_chat_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN_TOKENS", 40)
    monkeypatch.setattr(chat, "HISTORY_TOKENS", 15)
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    rng = random.Random(5)
    odd = ["</s>\n[user] x", "\\", "\\\\</s>", "[]<>", "", None, " </s>\n", "\\[", "a\nb", "[/INST]"]
    rows = []
    for c in range(6):
        if c % 2:
            rows.append((c, -1, "system", "be kind [x]"))
        for t in range(rng.randint(1, 30)):
            words = " ".join(rng.choice(["alpha", "beta", "<|x|>"]) for _ in range(rng.randint(0, 25)))
            rows.append((c, t, rng.choice(["user", "assistant", "a]b", None]), rng.choice([words, words, *odd])))
    rows += [(3, 2, "user", "same"), (3, 2, "user", "same"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, window int")
    made = chat.windows(df)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(
            ((-(2**62) if t is None else t, r or "", x or "") for k, t, r, x in rows if k == c)
        )
        turns = [(r, x) for _, r, x in own]
        learnt = "".join(x for r, x in turns if r == "assistant")
        assert (back[c].n_turns, back[c].turns_sha256) == (len(turns), digest(turns))
        assert (back[c].loss_chars, back[c].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    for w in made.where("conv_id = 1 and window > 0").collect():
        assert w.text.startswith("[system] be kind \\[x\\] </s>\n") and w.repeated >= 1
    assert chat.read_back(chat.windows(df.limit(0))).collect() == []


def test_mix_meets_targets_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = mixing.mix_counts(docs)
    rows = out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - r.g) <= 2 * r.m for r in rows)
    assert abs(sum(r.g for r in rows) - out.agg(F.sum("size")).first()[0]) < 1
    again = {tuple(r) for r in mixing.mix_counts(docs.repartition(7)).select("doc_id", "taken").collect()}
    assert again == {tuple(r) for r in out.select("doc_id", "taken").collect()}


@pytest.mark.parametrize("sizes", [[10, 1000, 1000], [1, 1, 1, 97], [0, 0], [5]])
def test_targets_stop_at_three_times_the_source(spark, sizes):
    rows = [(k, "w " * n, f"s{k}") for k, n in enumerate(sizes)]
    got = mixing.mix_counts(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).orderBy("source").collect()
    weight, target, open_ = [1 + k % 3 for k in range(len(sizes))], [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        left = sum(sizes) - sum(3 * sizes[k] for k in range(len(sizes)) if k not in open_)
        for k in open_:
            target[k] = left * weight[k] / sum(weight[j] for j in open_)
        over = {k for k in open_ if target[k] > 3 * sizes[k]}
        if not over:
            break
        for k in over:
            target[k] = 3.0 * sizes[k]
        open_ -= over
    assert [r.target for r in got] == pytest.approx(target)


def test_mix_takes_awkward_rows(spark):
    docs = awkward(spark)
    out = mixing.mix_counts(docs)
    assert out.count() == 9 and all(r.taken <= 3 * r.size for r in out.collect())
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix_counts(empty(spark)).collect() == [] and mixing.mixed(empty(spark)).collect() == []
