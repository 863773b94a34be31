"""Licence scan, in Spark expressions only: TF-IDF cosine of notices and licence texts to templates, then inheritance along directories.

A unit is a line or sentence of a text that holds one of ``CUES``, a paragraph (line breaks joined, comment marks left
out), a sentence of one, the comment at the head of a text, or the whole text. Units and the templates (``TEMPLATES``,
``HEADERS``, SPDX tags of ``SPDX``, and the full licence texts in ``licences/``) are sparse vectors of lower-case ASCII
words; a word weighs its count times ln((1 + N) / (1 + df)) + 1, with N and df counted over all lines and sentences with
a cue. A unit of cosine ``CLOSE`` or more to a template carries that template's licence if it holds the licence's telling
words too: its name and version (``TELLING``), its tag, or those of a full text (``FULL``).

A licence file is a text, of any length, that is close to a full licence text as a whole, or that its path names LICENSE,
COPYING or NOTICE. Its licence is that of the whole text, else its best notice, and holds for its directory. A text
without a licence of its own takes that of the nearest ancestor directory that has one. Where paths name no files,
``short_words`` also takes texts of at most so many words with a notice as licence files, behind the others.

Equal units are scored once; the directories are resolved once each, not per file. Ties go to the higher cosine,
then to the smaller licence name and path. Null or empty text has no notice but may inherit; a null path
is the root directory's. Repeated rows get equal results; an empty table gives an empty result. Other columns pass
through; clashing output columns are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import stored, words_of

#: Short standard notices of common licences.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
#: Notices that stand in headers, and titles of licences without a full text here.
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published"
    " by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
HEADERS = (
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the'
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)
#: Licences with an SPDX tag as template.
SPDX = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)


def _named_version(name: str, version: str) -> str:
    """Name before version with other words between, or ``version N of the name``; words as of :func:`plain`."""
    after = rf"\b(?:{name}) (?:[a-z0-9]+ ){{0,12}}?(?:version |v ?)?{version}"
    return rf"{after}|\b(?:version |v ?){version} (?:or later |of |the )+(?:{name})\b"


_GNU_2, _GNU_3 = r"2(?: 0)?\b(?! [0-9])", r"3(?: 0)?\b(?! [0-9])"
_LESSER = "(?:lesser|library) general public licen[cs]e|lgpl"
#: Name and version, as of :func:`plain`, without which no notice is taken for the licence.
TELLING = {
    "AGPL-3.0": _named_version("affero general public licen[cs]e|agpl", r"3\b") + r"|\bagplv3\b",
    "Apache-2.0": _named_version("apache(?: software)?(?: licen[cs]e)?", r"2(?: 0)?\b"),
    "BSD-2-Clause": "bsd 2 clause|2 clause bsd|simplified bsd|freebsd licen[cs]e",
    "BSD-3-Clause": "bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd",
    "CC-BY-4.0": r"\bcc by 4 0\b|creative commons attribution 4 0\b",
    "CC-BY-NC-4.0": r"\bcc by nc 4 0\b|creative commons attribution non ?commercial 4 0\b",
    "CC-BY-SA-4.0": r"\bcc by sa 4 0\b|creative commons attribution share ?alike 4 0\b",
    "CC0-1.0": r"\bcc0 1 0\b",
    "GPL-2.0": _named_version("gnu general public licen[cs]e|gpl", _GNU_2) + r"|\bgplv2\b",
    "GPL-3.0": _named_version("gnu general public licen[cs]e|gpl", _GNU_3) + r"|\bgplv3\b",
    "ISC": r"\bisc\b",
    "LGPL-2.1": _named_version(_LESSER, r"2 1\b") + r"|\blgplv2 1\b",
    "LGPL-3.0": _named_version(_LESSER, _GNU_3) + r"|\blgplv3\b",
    "MIT": r"\bmit\b(?! 0\b)",
    "MPL-2.0": _named_version("mozilla public licen[cs]e|mpl", r"2 0\b"),
}
CUES = "(?i)licen[cs]e|copyright|spdx"
#: Cues of licence texts that may lack the others.
FULL_CUES = f"{CUES}|permission|redistribut|public\\s+domain|altered\\s+source"
CLOSE = 0.6
#: The query's ``short_words``: its paths name no files.
FILE_WORDS = 60
#: Full licence texts and the words, as of :func:`plain`, without which no text is taken for them.
FULL = (
    ("Apache-2.0", "apache license version 2 0 january 2004|terms and conditions for use reproduction and distribution 1 definitions"),
    ("BSD-2-Clause", "^(?!.*endorse or promote).*redistributions in binary form must reproduce"),
    ("BSD-3-Clause", "redistributions in binary form must reproduce.*endorse or promote"),
    ("CC-BY-SA-4.0", "attribution sharealike 4 0 international"),
    ("CC0-1.0", "cc0 1 0 universal"),
    ("GPL-2.0", r"\bgnu general public license version 2 june 1991"),
    ("GPL-3.0", r"\bgnu general public license version 3 29 june 2007"),
    ("ISC", "permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1 february 1999"),
    ("LGPL-3.0", "gnu lesser general public license version 3 29 june 2007"),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MPL-2.0", "mozilla public license version 2 0"),
    ("Unlicense", "free and unencumbered software released into the public domain"),
    ("Zlib", "altered source versions must be plainly marked"),
)
#: File names of licence files, and endings of those that only deal with licences.
_NAMED = r"(?i)^(?:[\w+-]+[-_.])?(?:(?:un)?licen[cs]es?|copying|notices?)(?:[-_.][\w.+-]*)?$"
_CODE = r"(?i)\.(?:py|pyi|ipynb|js|jsx|mjs|ts|tsx|java|kt|scala|go|rs|rb|php|cs|c|cc|cpp|h|hpp|m|swift|sh|ps1|sql|r|pl|lua|css|scss|json|ya?ml|toml|xml)$"
#: Sentence ends at which a line is cut further.
_SENTENCE = r"\n|(?<=[.!?])\x20+"
#: Blank lines, also those of comment marks only; line breaks with the comment marks of the next line.
_PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
_BREAK = r"\n[^\p{L}\p{N}\n]*+"
#: A comment between delimiters at the head of a text, and lines that are comments or hold no word.
_DELIMITED = r'^(?:#![^\n]*\n)?\s*+(?:/\*(?s:.*?)\*/|<!--(?s:.*?)-->|"""(?s:.*?)"""|\(\*(?s:.*?)\*\))'
_COMMENT = r"^(?:\s*+(?://|#|\*|/\*|--|;|%|!|\.\.|dnl\b|(?i:rem)\b).*|[^\p{L}\p{N}]*+)$"
#: Any telling words, as of :func:`plain`.
_ANY = "|".join(f"(?:{x})" for x in (*TELLING.values(), r"\bspdx license identifier\b", *(telling for _, telling in FULL)))
#: An SPDX tag of more than one licence, as of :func:`plain`.
_EXPRESSION = r"\bspdx license identifier (.+ (?:or|and|with) .+)"
_OUT = ("license", "licenses", "cosine", "inherited", "inherited_from")


def notices(text: Column) -> Column:
    """Lines and sentences with a cue; texts without one are not split."""
    parts = F.filter(F.split(text, _SENTENCE), lambda x: x.rlike(CUES))
    return F.when(text.rlike(CUES), parts).otherwise(F.array().cast("array<string>"))


def alternatives(units: Column) -> Column:
    """The licences of each SPDX expression among ``units`` as tags of their own, all as of :func:`plain`."""
    tags = F.filter(units, lambda x: x.rlike(_EXPRESSION))
    rests = F.transform(tags, lambda x: F.split(F.regexp_extract(x, _EXPRESSION, 1), " (?:or|and|with) "))
    return F.transform(F.flatten(rests), lambda x: F.concat(F.lit("spdx license identifier "), x))


def header(text: Column) -> Column:
    """The comment at the head of a text: its delimited comment, else its lines up to the first outside a comment."""
    delimited = F.regexp_extract(text, _DELIMITED, 0)
    rows = F.split(text, "\n")
    code = F.array_position(F.transform(rows, lambda x: ~x.rlike(_COMMENT)), F.lit(True))
    lead = F.when(code == 0, rows).otherwise(F.slice(rows, F.lit(1), F.greatest(code.cast("int") - 1, F.lit(0))))
    return F.when(delimited != "", delimited).otherwise(F.array_join(lead, "\n"))


def blocks(text: Column) -> Column:
    """Header, paragraphs and their sentences that have telling words, as of :func:`plain`; line breaks are joined."""
    cued = F.when(text.rlike(FULL_CUES), text)
    paragraphs = F.split(cued, _PARAGRAPH)
    joined = F.transform(paragraphs, lambda x: F.regexp_replace(x, _BREAK, " "))
    sentences = F.flatten(F.transform(joined, lambda x: F.split(x, _SENTENCE)))
    units = F.transform(F.concat(F.array(header(cued)), joined, sentences), plain)
    told = F.filter(F.array_distinct(units), lambda x: x.rlike(_ANY))
    return F.coalesce(told, F.array().cast("array<string>"))


def plain(text: Column) -> Column:
    """Lower-case ASCII words of a text with one space between them."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1), " ")


def full_text(text: Column) -> Column:
    """The words of a text that has telling words of a full licence text, else null."""
    words = plain(F.when(text.rlike(FULL_CUES), text))
    return F.when(words.rlike("|".join(f"(?:{telling})" for _, telling in FULL)), words)


def is_named(path: Column) -> Column:
    """Whether the path names a licence file."""
    name = F.element_at(F.split(path, "/"), -1)
    return name.rlike(_NAMED) & ~name.rlike(_CODE)


def templates() -> list[tuple[int, str, bool, str, str]]:
    """Every template: number, licence, whether it is a full text, telling words, words."""
    folder = Path(__file__).with_name("licences")
    texts = [(name, True, telling, (folder / f"{name}.txt").read_text()) for name, telling in FULL]
    notes = [(name, text) for name, text in (*TEMPLATES, *HEADERS) if not text.startswith("SPDX")]
    texts += [(name, False, TELLING[name], text) for name, text in notes]
    for name in SPDX:
        tag = " ".join(re.findall("[a-z0-9]+", name.lower()))
        # The tag may stand anywhere in an expression; MIT-0 is another licence.
        telling = rf"\bspdx license identifier (?:[a-z0-9]+ ){{0,12}}?{tag}\b(?! (?:0|no|clear|modern|modification)\b)"
        texts.append((name, False, telling, f"SPDX-License-Identifier: {name}"))
    return [(k, name, full, telling, " ".join(re.findall("[a-z0-9]+", t.lower()))) for k, (name, full, telling, t) in enumerate(texts)]


def scored(units: DataFrame, lines: DataFrame) -> DataFrame:
    """Templates that each distinct unit is close to: unit, license, full, cosine.

    ``units`` has unit and words; ``lines`` has the words and times of every line or sentence with a cue, for the weights.
    """
    spark = units.sparkSession
    seen = lines.select("times", F.explode(F.array_distinct(F.split("words", " "))).alias("term"))
    df = seen.groupBy("term").agg(F.sum("times").alias("df"))
    total = lines.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("total"))
    idf = F.log((1 + F.col("total")) / (1 + F.coalesce("df", F.lit(0)))) + 1

    def weighed(counted: DataFrame) -> DataFrame:
        # The total is one row.
        return counted.join(df, "term", "left").join(F.broadcast(total)).withColumn("w", F.col("tf") * idf)

    all_ = templates()
    counts = [(k, term, tf) for k, *_, words in all_ for term, tf in Counter(words.split()).items()]
    known = weighed(spark.createDataFrame(counts, "template int, term string, tf bigint"))
    known = known.select("template", "term", F.col("w").alias("tw"))
    norms = known.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    named = spark.createDataFrame([t[:4] for t in all_], "template int, license string, full boolean, telling string")
    counted = units.select("unit", F.explode(F.split("words", " ")).alias("term")).groupBy("unit", "term")
    own = weighed(counted.agg(F.count(F.lit(1)).alias("tf"))).select("unit", "term", "w")
    own_norms = own.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    # The templates are a fixed number of words.
    dots = own.join(F.broadcast(known), "term").groupBy("unit", "template")
    dots = dots.agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosines = dots.join(F.broadcast(norms), "template").join(own_norms, "unit")
    cosines = cosines.withColumn("cosine", F.col("dot") / (F.col("tn") * F.col("n"))).where(F.col("cosine") >= CLOSE)
    told = cosines.join(F.broadcast(named), "template").join(units, "unit")
    told = told.where(F.regexp_like("words", F.col("telling")))
    return told.select("unit", "license", "full", "cosine")


def ancestors(path: Column) -> Column:
    """Directories above a path, nearest first; the root is the empty string."""
    parts = F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    depths = F.reverse(F.sequence(F.lit(0), F.size(parts)))
    return F.transform(depths, lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def scan(files: DataFrame, key: str, path: Column, text: str = "text", short_words: int | None = None) -> DataFrame:
    """``files`` with license, licenses, cosine, and the licence inherited and the directory it comes from.

    ``license`` is that of the closest notice; ``licenses`` has, sorted, the licences of all notices of the text, each
    licence of an SPDX expression included, and is empty where there is none.

    ``key`` names the rows; rows of equal key share their best notice.
    """
    columns = [c for c in files.columns if c not in _OUT]
    at = F.coalesce(path, F.lit(""))
    short = F.lit(False) if short_words is None else F.size(words_of(F.col("__text"))) <= short_words
    cued = files.where(F.col(text).rlike(FULL_CUES))
    cued = cued.select(F.col(key).alias("__key"), at.alias("__path"), F.col(text).alias("__text"))
    content = F.col("__text")
    units = cued.select(
        "__key",
        "__path",
        F.transform(notices(content), plain).alias("__lines"),
        blocks(content).alias("__blocks"),
        full_text(content).alias("__full"),
        short.alias("__short"),
    ).withColumns({"__dir": F.get(ancestors(F.col("__path")), F.lit(0)), "__named": is_named(F.col("__path"))})
    # Texts are searched and cut once, where they lie; what follows reads the units of those that have a cue.
    units = stored(units, "licence_units")
    placed = files.select(*columns, at.alias("__path")).withColumn("__dir", F.get(ancestors(F.col("__path")), F.lit(0)))
    lines = units.select(F.explode("__lines").alias("words")).groupBy("words").agg(F.count(F.lit(1)).alias("times"))
    unit = lambda words, whole: F.struct(words.alias("words"), F.lit(whole).alias("whole"))
    told = F.filter(F.array_union("__lines", "__blocks"), lambda x: x.rlike(_ANY))
    parts = F.concat(
        F.transform(F.array_union(told, alternatives(told)), lambda x: unit(x, False)),
        F.when(F.col("__full").isNull(), F.array()).otherwise(F.array(unit(F.col("__full"), True))),
    )
    held = units.select("__key", "__path", "__dir", "__short", "__named", F.explode(parts).alias("u"))
    held = held.select("*", F.md5("u.words").alias("unit"), "u.whole", "u.words").drop("u")
    distinct = held.groupBy("unit").agg(F.first("words").alias("words"))
    found = held.drop("words").join(scored(distinct, lines), "unit").withColumn("full", F.col("full") & F.col("whole"))
    better = F.struct(~F.col("full"), -F.round("cosine", 9), "license", "__path")
    own = found.groupBy("__key").agg(
        F.min_by("license", better).alias("license"),
        F.min_by("cosine", better).alias("cosine"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
    )
    sure = F.col("full") | F.col("__named")
    in_files = found.where(sure | F.col("__short")).groupBy(F.col("__dir").alias("up"))
    in_files = in_files.agg(F.min_by("license", F.struct(~sure, better)).alias("dir_license"))
    dirs = placed.select("__dir").distinct()
    chain = F.array_distinct(F.concat(F.array("__dir"), ancestors(F.col("__dir"))))
    up = dirs.select("__dir", F.posexplode(chain).alias("far", "up"))
    nearest = up.join(in_files, "up").groupBy("__dir")
    nearest = nearest.agg(F.min_by(F.struct("up", "dir_license"), "far").alias("__near"))
    out = placed.join(own, F.col(key).eqNullSafe(F.col("__key")), "left").join(nearest, "__dir", "left")
    lacks = F.col("license").isNull()
    return out.select(
        *columns,
        "license",
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        "cosine",
        F.when(lacks, F.col("__near.dir_license")).alias("inherited"),
        F.when(lacks, F.col("__near.up")).alias("inherited_from"),
    )
