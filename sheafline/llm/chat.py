"""Chat formatting in budgeted windows, in Spark expressions only.

Turns of a conversation are ordered by turn number (ties by role and text). A running sum of their tokens (words, plus
two for the markers) cuts the conversation into turn-aligned spans: a turn belongs to the span in whose ``SPAN_TOKENS``
its sum begins. A window is the system turn, if an earlier span holds it, then the last turns of the span before it as
far as ``HISTORY_TOKENS`` reach, then the turns of the span. The loss mask covers the assistant texts of the span
only, so a repeated target is masked out and each assistant text is trained on once.

A turn is written as ``[role] text </s>`` and a line feed. A backslash is put before every backslash, ``[``, ``]`` and
``<`` of a role or text, so no marker can arise inside one and removing it restores the text.

Null text and null role count as empty; a null turn number sorts first. A null ``conv_id`` is a conversation of its
own. Repeated rows are turns of their own. An empty table gives no window. Other columns are ignored.

A conversation that holds a large share of all rows is summed in blocks of its turn numbers and its windows are built
apart from one another; only ``read_back``, whose digests run over a whole conversation, brings one together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.llm.common import stored, words_of

SPAN_TOKENS = 1024
HISTORY_TOKENS = 256
#: Turn numbers of one block of the running sum.
BLOCK_TURNS = 1024

END = " </s>\n"
_END_RE = r" </s>\n"
_ROLE_RE = r"(?s)^\[((?:[^\\\]]|\\.)*)\] "


def escape(text: Column) -> Column:
    """Put a backslash before the characters that markers are made of."""
    return F.regexp_replace(text, r"([\\\[\]<])", r"\\$1")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(turns: DataFrame) -> DataFrame:
    """One row per window: conv_id, window, text, repeated (turns at its head from earlier windows), loss spans.

    ``loss`` is an array of (start, length) in code points from 0.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    base = turns.select(
        F.col("conv_id").isNull().alias("__cn"),
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("__c"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**62))).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.size(words_of(text)) + 2).cast("bigint").alias("tokens"),
    ).withColumn("__b", F.floor(F.col("turn") / BLOCK_TURNS))
    conv = ["__cn", "__c"]
    inside = Window.partitionBy(*conv, "__b").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*conv).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = base.groupBy(*conv, "__b").agg(F.sum("tokens").alias("__t"), F.count(F.lit(1)).alias("__n"))
    blocks = blocks.select(
        *conv,
        "__b",
        F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__t0"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"),
    )
    scanned = base.select(
        "*", F.sum("tokens").over(inside).alias("__ti"), F.count(F.lit(1)).over(inside).alias("__ni")
    ).join(blocks, [*conv, "__b"])
    begin = F.col("__t0") + F.col("__ti") - F.col("tokens")
    head, body = F.concat(F.lit("["), escape(F.col("role")), F.lit("] ")), escape(F.col("text"))
    placed = scanned.select(
        *conv,
        (F.col("__n0") + F.col("__ni")).alias("pos"),
        begin.alias("begin"),
        F.floor(begin / SPAN_TOKENS).cast("bigint").alias("window"),
        "role",
        head.alias("__head"),
        body.alias("__body"),
    ).select(
        *conv,
        "pos",
        "begin",
        "window",
        "role",
        F.concat("__head", "__body", F.lit(END)).alias("piece"),
        F.length("__head").alias("skip"),
        F.length("__body").alias("body"),
    )
    # Numbered once; what follows reads a few columns of it and moves every piece once more, to its windows.
    placed = stored(placed, "turns")

    fresh = F.struct("window", F.lit(False).alias("again"))
    later = F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("again"))
    near_end = F.col("begin") + HISTORY_TOKENS >= (F.col("window") + 1) * SPAN_TOKENS
    turn = lambda again, retained: F.struct(
        "pos", again.alias("again"), "piece", "skip", "body",
        (~again & (F.col("role") == "assistant")).alias("loss"), "begin", F.lit(retained).alias("retained"),
    ).alias("t")
    rows = placed.select("*", F.explode(F.when(near_end, F.array(fresh, later)).otherwise(F.array(fresh))).alias("at"))
    rows = rows.select(*conv, "at.window", turn(F.col("at.again"), False))
    system = placed.where(F.col("role") == "system").groupBy(*conv)
    system = system.agg(F.min_by(F.struct("window", turn(F.lit(True), True)), "pos").alias("__s"))
    retained = (
        placed.select(*conv, "window").distinct().join(system, conv).where(F.col("window") > F.col("__s.window"))
    ).select(*conv, "window", "__s.t")
    grouped = rows.unionByName(retained).groupBy(*conv, "window").agg(F.collect_list("t").alias("all"))
    # A window that only history reaches does not exist; its first own turn says how far the history goes back.
    grouped = grouped.withColumns(
        {
            "__start": F.array_min(F.transform(F.filter("all", lambda t: ~t.again), lambda t: t.begin)),
            "__system": F.array_max(F.transform(F.filter("all", lambda t: t.retained), lambda t: t.pos)),
        }
    ).where("__start IS NOT NULL")
    recent = lambda t: (F.col("__start") - t.begin <= HISTORY_TOKENS) & ~t.pos.eqNullSafe(F.col("__system"))
    grouped = grouped.select(
        *conv, "window", F.array_sort(F.filter("all", lambda t: ~t.again | t.retained | recent(t))).alias("ts")
    )
    ts = F.col("ts")
    spans = F.aggregate(
        ts,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc.at + F.length(t.piece)).alias("at"),
            F.when(
                t.loss,
                F.array_append(acc.spans, F.struct((acc.at + t.skip).alias("start"), t.body.alias("length"))),
            ).otherwise(acc.spans).alias("spans"),
        ),
    )
    return grouped.select(
        F.when(~F.col("__cn"), F.col("__c")).alias("conv_id"),
        "window",
        F.array_join(F.transform(ts, lambda t: t.piece), "").alias("text"),
        F.size(F.filter(ts, lambda t: t.again)).alias("repeated"),
        spans.spans.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Conversations restored from their windows alone, as digests: one row per conversation."""
    every = F.split("text", _END_RE)
    # The last piece is empty: a window ends with a marker.
    pieces = F.slice(every, F.col("repeated") + 1, F.size(every) - 1 - F.col("repeated"))
    turns = F.transform(
        F.col("__pieces"),
        lambda x: F.concat(
            unescape(F.regexp_extract(x, _ROLE_RE, 1)),
            F.lit("\n"),
            unescape(F.regexp_replace(x, _ROLE_RE, "")),
            F.lit("\n"),
        ),
    )
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s.start + 1, s.length)))
    parts = formatted.withColumn("__pieces", pieces).select(
        F.col("conv_id"),
        F.struct(
            "window",
            F.array_join(turns, "").alias("turns"),
            F.array_join(learnt, "").alias("learnt"),
            F.size("__pieces").cast("bigint").alias("n"),
            F.length("text").cast("bigint").alias("chars"),
        ).alias("w"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    joined = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    summed = lambda name: F.aggregate(
        "ws", F.lit(0).cast("bigint"), lambda a, w: a + w[name]
    )
    return whole.select(
        "conv_id",
        summed("n").alias("n_turns"),
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("learnt")).cast("bigint").alias("loss_chars"),
        F.sha2(joined("learnt"), 256).alias("loss_sha256"),
        summed("chars").alias("formatted_chars"),
    )
