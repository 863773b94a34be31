"""HTML pages with embedded JSON-LD -> graphs.

Blocks are found with JVM-side expressions. Reading a block needs lenient JSON and unbounded nesting, which
Spark expressions do not offer, so the small walker below runs in an Arrow UDF over the blocks only (never
over whole pages). The graph of a page stays in the page's own row as subject -> predicate -> objects: a
page is one input row, so the value is bounded by the page, reading it needs lookups instead of shuffles,
and the same expressions run on streams. :func:`to_triples` gives the flat table.

Supported JSON-LD: schema.org and inline contexts with text or ``@id`` term definitions, ``@graph``, ``@id``,
``@type``, ``@value``, ``@set``, nested nodes and lists of them. Anything else makes the page an error.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SCHEMA_HTTPS = "https://schema.org/"
SCHEMA_HTTP = "http://schema.org/"

OBJECTS = "array<struct<kind:string,o:string>>"
_OBJECT_TYPE = T.StructType().add("kind", T.StringType()).add("o", T.StringType())
_GRAPH_TYPE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(_OBJECT_TYPE)))
_READ_TYPE = T.StructType().add("graph", _GRAPH_TYPE).add("error", T.StringType())

_SCRIPT_OR_COMMENT = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>.*?</\1(?=[\s/>])"
)
_JSONLD_OPEN = (
    r"(?is)\A<script\b(?=(?:[^>\"'\s]+|\"[^\"]*\"|'[^']*'|\s(?!type\s*=))*+\stype\s*=\s*(?:\"(?-i:application/ld\+json)\"|'(?-i:application/ld\+json)'"
    r"|(?-i:application/ld\+json)(?=[\s>])))(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
)
_CLOSE = r"(?is)</script\z"


def jsonld_blocks(html: Column) -> Column:
    """Text of the JSON-LD scripts of a page in order; scripts inside comments and unclosed ones do not count."""
    matches = F.regexp_extract_all(html, F.lit(_SCRIPT_OR_COMMENT), F.lit(0))
    scripts = F.filter(matches, lambda m: m.rlike(_JSONLD_OPEN))
    return F.transform(scripts, lambda m: F.regexp_replace(F.regexp_replace(m, _JSONLD_OPEN, ""), _CLOSE, ""))


def read_jsonld_blocks(pages: DataFrame) -> DataFrame:
    """``url, block_no, json`` of every JSON-LD block (``pages``: ``url, html``)."""
    return pages.select("url", F.posexplode(jsonld_blocks(F.col("html"))).alias("block_no", "json"))


def no_block_error(pages: DataFrame) -> DataFrame:
    """Pages without any block."""
    return pages.filter(F.size(jsonld_blocks(F.col("html"))) == 0).select(
        "url", F.concat(F.lit("No JSON-LD blocks found in HTML at: "), "url").alias("message")
    )


class _Unsupported(ValueError):
    """A JSON-LD construct outside the supported part."""


_SCHEMA_CONTEXT = re.compile(r"https?://schema\.org(/|/docs/jsonldcontext\.json(ld)?)?")
_PASSED_OVER = {"@context", "@id", "@graph", "@index", "@language"}


def _read_context(value, vocab, terms):
    """Apply one context value to an inherited vocabulary and term map."""
    for part in value if isinstance(value, list) else [value]:
        if part is None:
            vocab, terms = None, {}
        elif isinstance(part, str) and _SCHEMA_CONTEXT.fullmatch(part):
            vocab, terms = SCHEMA_HTTP, {**terms, "schema": SCHEMA_HTTP}
        elif isinstance(part, dict):
            vocab = part.get("@vocab", vocab)
            named = {k: v.get("@id") if isinstance(v, dict) else v for k, v in part.items() if k[:1] != "@"}
            terms = {**terms, **{k: v for k, v in named.items() if isinstance(v, str)}}
        else:
            raise _Unsupported(f"context {part!r}")
    return vocab, terms


def _iri(term, vocab, terms):
    """Full IRI of a term, or None when the context does not define it."""
    term = terms.get(term, term)
    prefix, colon, rest = term.partition(":")
    if colon:
        return terms[prefix] + rest if prefix in terms and not rest.startswith("//") else term
    return vocab + term if vocab else None


def _text(value):
    return value if isinstance(value, str) else json.dumps(value)


def _open(node, place, vocab, terms):
    """Resolve a node's context and keyword aliases: (kind, id), members, vocabulary, terms."""
    vocab, terms = _read_context(node.get("@context", []), vocab, terms)
    members = {terms[k] if terms.get(k, "").startswith("@") else k: v for k, v in node.items()}
    own = members.get("@id")
    if not isinstance(own, str):
        named = ("bnode", place)
    elif own.startswith("_:"):
        # Labels are local to a page, so they carry its name.
        named = ("bnode", f"{place.split('-')[0]}-{own[2:]}")
    else:
        named = ("iri", own)
    return named, members, vocab, terms


def _listed(value):
    if isinstance(value, dict) and "@set" in value:
        value = value["@set"]
    return value if isinstance(value, list) else [value]


def _walk(opened, place, graph):
    """Add an opened node and everything nested in it to the graph."""
    (_, subject), members, vocab, terms = opened
    for key, value in members.items():
        if key in _PASSED_OVER:
            continue
        if key[:1] == "@" and key != "@type":
            raise _Unsupported(f"keyword {key}")
        predicate = RDF_TYPE if key == "@type" else _iri(key, vocab, terms)
        if predicate is None:
            continue
        for i, item in enumerate(_listed(value)):
            if isinstance(item, dict) and "@value" in item:
                item = item["@value"]
            if item is None or isinstance(item, list):
                continue
            child = None
            if key == "@type":
                found = ("iri", _iri(item, vocab, terms))
            elif isinstance(item, dict):
                child = _open(item, f"{place}-{key}-{i}", vocab, terms)
                found = child[0]
            else:
                found = ("literal", _text(item))
            if found[1] is not None:
                # The triple comes before those of the node it leads to: document order.
                graph.setdefault(subject, {}).setdefault(predicate, {})[found] = None
            if child is not None:
                _walk(child, f"{place}-{key}-{i}", graph)
    for i, item in enumerate(_listed(members.get("@graph", []))):
        if isinstance(item, dict):
            _walk(_open(item, f"{place}-g{i}", vocab, terms), f"{place}-g{i}", graph)


def read_page_graph(url: str, blocks: list[str]) -> tuple[dict | None, str | None]:
    """Merged graph of a page's blocks, or the reason why there is none. One bad block fails the page."""
    if not blocks:
        return None, f"No JSON-LD blocks found in HTML at: {url}"
    # Nodes without an id are named after the page and their place in it, so reruns agree.
    page = "n" + hashlib.sha256(url.encode()).hexdigest()[:16]
    graph: dict = {}
    for n, block in enumerate(blocks):
        try:
            # Raw control characters inside strings are common in the wild.
            value = json.loads(block, strict=False)
        except (ValueError, RecursionError) as exc:
            return None, f"Invalid JSON in JSON-LD block at {url}: {exc}\nBlock:\n{block}"
        try:
            for i, node in enumerate(value if isinstance(value, list) else [value]):
                if isinstance(node, dict):
                    _walk(_open(node, f"{page}-{n}-{i}", None, {}), f"{page}-{n}-{i}", graph)
        except (_Unsupported, RecursionError, TypeError, AttributeError) as exc:
            return None, f"Failed to parse JSON-LD at {url}: {exc}\nBlock:\n{block}"
    return graph, None


# The walker travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ARROW_OBJECTS = pa.list_(pa.struct([("kind", pa.string()), ("o", pa.string())]))
_ARROW_READ = pa.struct(
    [("graph", pa.map_(pa.string(), pa.map_(pa.string(), _ARROW_OBJECTS))), ("error", pa.string())]
)


#: Pages whose parsed graphs exist as Python objects at the same time; an Arrow batch is read in such steps.
PAGES_AT_ONCE = 100


def _graph_row(url: str | None, texts: list[str] | None) -> dict:
    graph, error = read_page_graph(url or "", texts or [])
    if graph is None:
        return {"graph": None, "error": error}
    subjects = [
        (s, [(p, [{"kind": k, "o": o} for k, o in objects]) for p, objects in props.items()]) for s, props in graph.items()
    ]
    return {"graph": subjects, "error": error}


@F.arrow_udf(_READ_TYPE)
def _read_graphs(urls: pa.Array, blocks: pa.Array) -> pa.Array:
    done = []
    for start in range(0, len(urls), PAGES_AT_ONCE):
        step = zip(urls.slice(start, PAGES_AT_ONCE), blocks.slice(start, PAGES_AT_ONCE), strict=True)
        done.append(pa.array([_graph_row(u.as_py(), b.as_py()) for u, b in step], type=_ARROW_READ))
    return pa.concat_arrays(done) if done else pa.array([], type=_ARROW_READ)


# Nondeterministic only so that the optimizer never copies the call into filters above it.
_READ_ONCE = _read_graphs.asNondeterministic()


def page_blocks(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by ``blocks``, the JSON-LD texts of the page. Joins belong after this step: blocks are
    a small part of a page."""
    keep = [c for c in pages.columns if c != "html"]
    return pages.select(*keep, jsonld_blocks(F.col("html")).alias("blocks"))


def block_graphs(pages: DataFrame) -> DataFrame:
    """Replace ``blocks`` by ``graph`` (subject -> predicate -> objects) and ``graph_error``."""
    keep = [c for c in pages.columns if c != "blocks"]
    read = pages.select(*keep, _READ_ONCE("url", "blocks").alias("__read"))
    return read.select(*keep, F.col("__read.graph").alias("graph"), F.col("__read.error").alias("graph_error"))


def page_graphs(pages: DataFrame) -> DataFrame:
    """Graphs of pages (``url, html, ...``)."""
    return block_graphs(page_blocks(pages))


def to_triples(graphs: DataFrame) -> DataFrame:
    """The graphs as a flat table ``url, ord, s, p, kind, o`` in document order."""
    per_subject = graphs.select("url", F.posexplode("graph").alias("sn", "s", "props"))
    per_predicate = per_subject.select("url", "sn", "s", F.posexplode("props").alias("pn", "p", "objects"))
    rows = per_predicate.select("url", "sn", "s", "pn", "p", F.posexplode("objects").alias("on", "t"))
    return rows.select("url", F.struct("sn", "pn", "on").alias("ord"), "s", "p", "t.kind", "t.o")
