"""Spans of regular-expression matches as native column expressions.

Spark's functions return the matches and the pieces between them, but no
positions; adding up the lengths gives code-point offsets. Patterns use
possessive quantifiers, so long runs cost linear time and no stack."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters before a span that its context holds.
CONTEXT = 40


def matches(text: Column, pattern: str, needs: Column, group: int = 0) -> Column:
    """Leftmost non-overlapping matches, in order: array of (start, end, value,
    part, before, after); ``part`` is the text of ``group``, ``before`` up to
    CONTEXT characters since the last match, ``after`` the next character.
    ``needs`` is a cheap condition without which there is no match."""
    def spans(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        parts = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else found
        rows = F.arrays_zip(F.split(t, pattern, -1).alias("gap"), found.alias("value"), parts.alias("part"))
        start = F.struct(F.array().cast(f"array<{_SPAN}>").alias("out"), F.lit(0).alias("at"))

        def step(state: Column, row: Column) -> Column:
            at = state["at"] + F.length(row["gap"])
            done = F.struct(at.alias("start"), (at + F.length(row["value"])).alias("end"), row["value"].alias("value"),
                            row["part"].alias("part"), F.right(row["gap"], F.lit(CONTEXT)).alias("before"), F.lit("").alias("after"))
            return F.struct(F.when(row["value"].isNull(), state["out"]).otherwise(F.array_append(state["out"], done)).alias("out"),
                            (at + F.coalesce(F.length(row["value"]), F.lit(0))).alias("at"))

        out = F.aggregate(rows, start, step, lambda s: s["out"])
        return F.transform(out, lambda s: s.withField("after", F.substring(t, s["end"] + 1, F.lit(1))))

    return F.when(needs, spans(text)).otherwise(F.array().cast(f"array<{_SPAN}>"))


_SPAN = "struct<start:int,end:int,value:string,part:string,before:string,after:string>"


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """(rank, kind, start, end) of spans of one kind."""
    return F.transform(spans, lambda s: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                                                 s["start"].alias("start"), s["end"].alias("end")))


def joined(spans: Column, by_kind: bool) -> Column:
    """``kind:start:end``, comma-joined, ordered by kind and start or by start
    and kind; ``spans`` as made by ``labelled``."""
    first, second = ("rank", "start") if by_kind else ("start", "rank")
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s[first], s[second], s["end"].alias("end"), s["kind"].alias("kind"),
                                                               s["start"].alias("from"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["end"].cast("string"))), ",")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.split(F.reverse(number), "")
    return F.aggregate(F.arrays_zip(n.alias("d"), F.sequence(F.lit(0), F.size(n) - 1).alias("i")), F.lit(0), lambda s, x: s + F.when(
        x["i"] % 2 == 0, x["d"].cast("int")).otherwise(F.when(x["d"].cast("int") > 4, 2 * x["d"].cast("int") - 9).otherwise(2 * x["d"].cast("int")))) % 10 == 0
