"""Personal and postal names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.text import concat_truthy, let, strip, truthy, words

# Tokens read as a title before, or a suffix after, a personal name, and family-name particles.
TITLES = (
    "dr", "doctor", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "dame", "lord", "lady", "rev",
    "reverend", "hon", "herr", "frau", "dipl", "dipl.-ing", "dipl.-biol", "ing", "madame", "mme", "mlle",
    "monsieur", "senor", "señor", "dean", "judge", "president", "captain", "capt", "col", "gen", "lt", "maj",
)
SUFFIXES = (
    "jr", "jnr", "junior", "sr", "snr", "senior", "esq", "esquire", "ii", "iii", "iv", "2", "phd", "ph.d", "md",
    "m.d", "mba", "msc", "bsc", "dds", "dvm", "cpa", "llb", "llm", "jd", "rn", "pe", "frs", "obe", "mbe", "cbe",
)
PARTICLES = (
    "von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "vom", "zu", "zum",
    "zur", "ter", "ten", "bin", "ibn", "al", "el", "san", "santa", "st",
)


def _bare(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), r"\.+$", "")


def _is_title(token: Column) -> Column:
    return _bare(token).isin(*TITLES)


def _is_suffix(token: Column) -> Column:
    return _bare(F.regexp_replace(token, r",+$", "")).isin(*SUFFIXES)


def _lead(tokens: Column, test) -> Column:
    """How many tokens at the front satisfy ``test``."""
    position = F.array_position(F.transform(tokens, lambda t: test(t)), F.lit(False))
    return F.when(position == 0, F.size(tokens)).otherwise(position - 1).cast("int")


def _from(tokens: Column, start: Column) -> Column:
    return F.slice(tokens, start, F.greatest(F.size(tokens), F.lit(1)))


def _drop_titles(tokens: Column) -> Column:
    """Titles stand before the first name and never take the last token."""
    return _from(tokens, F.greatest(F.least(_lead(tokens, _is_title), F.size(tokens) - 1), F.lit(0)) + 1)


def _drop_suffixes(tokens: Column, keep: int = 2) -> Column:
    """Suffixes stand at the end and never take the first ``keep`` tokens."""
    n = F.greatest(F.least(_lead(F.reverse(tokens), _is_suffix), F.size(tokens) - keep), F.lit(0))
    return F.slice(tokens, F.lit(1), F.size(tokens) - n)


def _family_size(tokens: Column) -> Column:
    """Tokens of the family name: from the first particle after the first name, else the last one."""
    particle = F.array_position(F.transform(_from(tokens, F.lit(2)), lambda t: _bare(t).isin(*PARTICLES)), F.lit(True))
    return let(
        particle.cast("int"),
        lambda at: F.when((at > 0) & (at < F.size(tokens) - 1), F.size(tokens) - at).otherwise(1),
    )


def _name(first: Column, last: Column) -> Column:
    return F.struct(first.alias("first"), last.alias("last"))


def _first_and_family(tokens: Column, with_middle: bool) -> Column:
    """Split tokens that carry no title or suffix any more."""

    def cut(n: Column) -> Column:
        given = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - n, F.lit(0)))
        first = F.array_join(given, " ") if with_middle else F.coalesce(F.get(given, F.lit(0)), F.lit(""))
        return _name(first, F.array_join(_from(tokens, F.greatest(F.size(tokens) - n, F.lit(0)) + 1), " "))

    return let(F.least(_family_size(tokens), F.size(tokens)), cut)


def _comma_form(w: Column) -> Column:
    """``Last, First Middle``, or a full name followed by credentials."""
    before, after = w["before"], w["after"]
    credentials = (F.size(before) > 1) & (F.size(after) > 0) & F.forall(after, _is_suffix)
    given = F.filter(_from(after, _lead(after, _is_title) + 1), lambda t: ~_is_suffix(t))
    return F.when(
        credentials, let(_drop_titles(before), lambda own: _first_and_family(own, with_middle=True))
    ).otherwise(_name(F.array_join(given, " "), F.array_join(_drop_suffixes(before, keep=1), " ")))


def _plain_form(tokens: Column) -> Column:
    """First token, then the rest; one token is a family name. A title or suffix drops the middle names."""
    plain = F.when(F.size(tokens) == 1, _name(F.lit(""), tokens[0])).otherwise(
        _name(tokens[0], F.array_join(_from(tokens, F.lit(2)), " "))
    )
    return let(
        _drop_titles(tokens),
        lambda untitled: let(
            _drop_suffixes(untitled),
            lambda core: F.when(F.size(core) == F.size(tokens), plain).otherwise(
                _first_and_family(core, with_middle=False)
            ),
        ),
    )


def split_name(name: Column) -> Column:
    """``struct<first,last>`` of a personal name: comma form, title or suffix form, plain form."""

    def split(text: Column) -> Column:
        parts = F.split(text, ",")
        sides = F.struct(
            words(parts[0]).alias("before"), words(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("after")
        )
        return (
            F.when(truthy(text).isNull(), _name(F.lit(""), F.lit("")))
            .when(text.contains(","), let(sides, _comma_form))
            .otherwise(let(words(text), _plain_form))
        )

    return let(strip(name), split)


def split_name_at_last_blank(name: Column) -> Column:
    """``struct<given,family>``: family is the last blank-separated part; a single part fills both."""
    parts = F.split(name, " ")
    return F.struct(
        F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " "))
        .otherwise(name)
        .alias("given"),
        F.element_at(parts, -1).alias("family"),
    )


def format_address(contact: Column) -> Column:
    """Street, city, region, postcode, country; null when all are empty."""
    return concat_truthy(", ", *[contact[f] for f in ("address", "city", "region", "postcode", "country")])
