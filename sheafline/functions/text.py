"""String, number and URL expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), lambda v: fn(v)), F.lit(0))


def truthy(c: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(c, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def is_filled(c: Column) -> Column:
    """Whether the text has anything but white space."""
    return c.rlike(r"(?U)[^\s\x1c-\x1f]")


def words(c: Column) -> Column:
    """Non-empty tokens between runs of white space."""
    return F.filter(F.split(c, rf"(?U){_SPACE}+"), lambda w: w != "")


def slug(c: Column) -> Column:
    """Lower-case identifier: runs of other characters become one underscore, 80 characters at most."""
    cleaned = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(truthy(c).isNull(), F.lit("untitled")).otherwise(F.substring(cleaned, 1, 80))


def truthy_list(arr: Column) -> Column:
    """Drop nulls and empty texts, keep order and repeats; a missing list is empty."""
    return F.filter(or_empty(arr), lambda x: x.isNotNull() & (x != ""))


def or_empty(arr: Column, ddl: str = "array<string>") -> Column:
    """An absent array as an empty one."""
    return F.coalesce(arr, F.array().cast(ddl))


def fold(arr: Column, sep: str) -> Column:
    """Join a list with ``sep``; null for an empty list."""
    return F.when(F.size(or_empty(arr)) > 0, F.array_join(arr, sep))


def head(arr: Column, n: int) -> Column:
    """The first ``n`` elements."""
    return F.slice(arr, 1, n)


def joined_or_omit(values: Column) -> Column:
    """``;``-join with nulls as empty slots; null when every slot is blank."""
    slots = F.transform(values, lambda v: F.coalesce(v, F.lit("")))
    text = F.array_join(slots, ";")
    return F.when(F.exists(slots, lambda v: strip(F.translate(v, ";", "")) != ""), text)


def concat_truthy(sep: str, *parts: Column) -> Column:
    """Join the non-empty parts; null when none is left."""
    return truthy(F.concat_ws(sep, *[truthy(p) for p in parts]))


def first_truthy(*cols: Column) -> Column:
    """The first non-empty text."""
    return F.coalesce(*[truthy(c) for c in cols])


_FLOAT = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$"
_FLOAT_WORD = r"^[+-]?(inf|infinity|nan)$"


def parse_float(c: Column) -> Column:
    """Decimal text as double; null for anything that is not a plain number."""
    text = F.lower(strip(c))
    word = F.regexp_replace(F.regexp_replace(text, "^([+-]?)inf$", "$1infinity"), "^[+-]nan$", "nan")
    return F.when(text.rlike(_FLOAT), F.translate(text, "_", "").try_cast("double")).when(
        text.rlike(_FLOAT_WORD), word.try_cast("double")
    )


def parse_int(c: Column) -> Column:
    """Whole-number text as bigint; null for anything else."""
    text = strip(c)
    return F.when(text.rlike("^[+-]?[0-9]+(_[0-9]+)*$"), F.translate(text, "_", "").try_cast("bigint"))


def float_text(x: Column) -> Column:
    """Shortest decimal text of a double: ``10.0``, ``15000000.0``, ``1e-05``, ``1e+16``."""
    raw = x.cast("string")
    size = F.abs(x)
    plain = F.regexp_replace(
        F.regexp_replace(x.cast("decimal(38,21)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", ".0"
    )
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    exponent = F.substring_index(raw, "E", -1).cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(""),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(raw == "Infinity", F.lit("inf"))
        .when(raw == "-Infinity", F.lit("-inf"))
        .when(~raw.contains("E"), raw)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


# --- URLs -----------------------------------------------------------------

_AUTHORITY = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]+)"


def _clean_url(url: Column) -> Column:
    return F.translate(F.regexp_replace(url, r"\A[\x00-\x20]+", ""), "\t\r\n", "")


def url_scheme(url: Column) -> Column:
    """Lower-case scheme, or null without scheme or host."""
    return truthy(F.lower(F.regexp_extract(_clean_url(url), _AUTHORITY, 1)))


def url_host(url: Column) -> Column:
    """Host key including the port, or null without scheme or host."""
    return truthy(F.regexp_extract(_clean_url(url), _AUTHORITY, 2))


def url_error(url: Column, what: str = "URL") -> Column:
    """Message for a URL without scheme or host, else null."""
    return F.when(url_host(url).isNull(), F.concat(F.lit(f"Invalid {what}: "), F.coalesce(url, F.lit(""))))


def base_url(url: Column) -> Column:
    """``scheme://host`` of a URL, or null when either part is missing."""
    return F.concat(url_scheme(url), F.lit("://"), url_host(url))


def url_target(url: Column) -> Column:
    """Path and query part, ``/`` at least."""
    rest = F.regexp_replace(F.regexp_replace(_clean_url(url), _AUTHORITY, ""), "#.*$", "")
    return F.when(rest == "", F.lit("/")).when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)


def receive_url(base: Column, object_id: Column) -> Column:
    """Landing page of one search hit; null for a blank id."""
    return F.when(is_filled(object_id), F.concat(base, F.lit("/receive/"), object_id))


def form_encode(c: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _form_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def solr_page_url(base: Column, start: Column) -> Column:
    """Search URL of the page at ``start``: an earlier ``start`` goes, the new one comes last."""
    front = F.regexp_extract(base, r"^([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(base, r"#(.+)$", 1)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda q: q != ""),
        lambda q: F.struct(
            _form_decode(F.substring_index(q, "=", 1)).alias("name"),
            _form_decode(F.when(q.contains("="), F.regexp_replace(q, "^[^=]*=", "")).otherwise("")).alias("value"),
        ),
    )
    kept = F.transform(
        F.filter(pairs, lambda p: p["name"] != "start"),
        lambda p: F.concat(form_encode(p["name"]), F.lit("="), form_encode(p["value"])),
    )
    all_pairs = F.concat(kept, F.array(F.concat(F.lit("start="), start.cast("string"))))
    return F.concat(
        front,
        F.lit("?"),
        F.array_join(all_pairs, "&"),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def record_url(base: Column, record_id: Column) -> Column:
    """Request URL of one catalogue record."""
    trimmed = F.regexp_replace(base, r"\?+\z", "")
    return F.concat(
        trimmed,
        F.when(trimmed.contains("?"), F.lit("&")).otherwise(F.lit("?")),
        F.lit("service=CSW&version=2.0.2&request=GetRecordById&id="),
        form_encode(record_id),
        F.lit("&outputSchema=http%3A%2F%2Fwww.isotc211.org%2F2005%2Fgmd&elementSetName=full"),
    )


def unquote(c: Column) -> Column:
    """Percent escapes decoded; ``+`` stays, malformed text stays as it is."""
    return F.when(c.contains("%"), _form_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)


def doi_from(identifier: Column, subject: Column) -> Column:
    """DOI of a dataset: its identifier, the part after ``doi.org/`` up to the next slash, or the subject."""
    in_subject = F.regexp_extract(subject, r"(?i)doi\.org/(10\.[^/?#]+)", 1)
    return (
        F.when(identifier.startswith("10."), identifier)
        .when(in_subject != "", in_subject)
        .when(subject.startswith("10."), subject)
    )


def all_of(*conditions: Column) -> Column:
    """Conjunction."""
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    """Disjunction."""
    return reduce(lambda a, b: a | b, conditions)
