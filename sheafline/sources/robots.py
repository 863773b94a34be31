"""Robots files -> rule rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import strip, unquote

_RULE = "struct<entry:int,agent:string,allow:boolean,path:string,crawl_delay:double>"
_STATE = f"struct<phase:string,entry:int,agents:array<string>,rules:array<{_RULE}>>"


def _line(raw: Column) -> Column:
    """A line without its comment, as directive and value; ``reset`` marks a really empty line."""
    text = strip(F.regexp_replace(raw, "#.*$", ""))
    return F.struct(
        (raw == "").alias("reset"),
        F.when(text.contains(":"), F.lower(strip(F.substring_index(text, ":", 1)))).alias("directive"),
        unquote(strip(F.regexp_replace(text, "^[^:]*:", ""))).alias("value"),
    )


def _step(state: Column, line: Column) -> Column:
    """Agents collect until the first rule; an empty line or a later agent line starts a new entry."""
    is_agent = line["directive"] == "user-agent"
    is_path = line["directive"].isin("allow", "disallow")
    is_delay = line["directive"] == "crawl-delay"
    joins = state["phase"] == "agents"
    entry = F.when(joins, state["entry"]).otherwise(state["entry"] + 1)
    agents = F.when(joins, state["agents"]).otherwise(F.array().cast("array<string>"))
    delay = F.when(line["value"].rlike("^[0-9]+$"), line["value"].try_cast("double"))
    rules = F.transform(
        state["agents"],
        lambda a: F.struct(
            state["entry"],
            a,
            line["directive"] == "allow",
            F.when(is_path, line["value"]),
            F.when(is_delay, delay),
        ).cast(_RULE),
    )
    counts = (is_path | is_delay) & (state["phase"] != "none")

    def to(phase: str | Column, entry: Column, agents: Column, rules: Column) -> Column:
        return F.struct(F.lit(phase) if isinstance(phase, str) else phase, entry, agents, rules).cast(_STATE)

    return (
        F.when(line["reset"], to("none", state["entry"], F.array().cast("array<string>"), state["rules"]))
        .when(is_agent, to("agents", entry, F.concat(agents, F.array(line["value"])), state["rules"]))
        .when(counts, to("rules", state["entry"], state["agents"], F.concat(state["rules"], rules)))
        .otherwise(state)
    )


def read_robots(files: DataFrame) -> DataFrame:
    """``host, entry, pos, agent, allow, path, crawl_delay`` of each landed file (``host, body``).

    One row per rule line and agent of its entry. A file is read within its own row. A file that failed to
    load has no rows, which allows everything.
    """
    lines = F.transform(F.split(F.coalesce("body", F.lit("")), r"\r\n|\r|\n"), _line)
    start = F.struct(F.lit("none"), F.lit(-1), F.array(), F.array()).cast(_STATE)
    read = files.select("host", F.aggregate(lines, start, _step, lambda st: st["rules"]).alias("rules"))
    return read.select("host", F.posexplode("rules").alias("pos", "r")).select(
        "host", "r.entry", "pos", "r.agent", "r.allow", "r.path", "r.crawl_delay"
    )
