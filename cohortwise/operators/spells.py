"""Continuous follow-up: collapse consecutive dated spells into islands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.dates import OPEN_END
from cohortwise.functions.study import StudyWindow


_EPOCH = "1970-01-01"
_DAY0 = 719162  # days from 0001-01-01 to 1970-01-01: shifts every date to >= 0
_SPAN = 1 << 22  # more days than 0001-01-01 .. 9999-12-31


def _days(c):
    return F.date_diff(c, F.lit(_EPOCH)).cast("long") + _DAY0


def _pack(s, e):
    """(start, end) -> one long ordered like the pair."""
    return _days(s) * _SPAN + _days(e)


def _unpack_end(v):
    return F.date_add(F.lit(_EPOCH).cast("date"), (v % _SPAN - _DAY0).cast("int"))


def merge_spells(
    rows: DataFrame,
    window: StudyWindow,
    rule: str = "pairwise",
    person: str = "person_id",
    start: str = "active_from",
    end: str = "active_to",
) -> DataFrame:
    """Islands of spells per person -> (person_id, entry_dt, exit_dt, rw_seq).

    Spells are ordered by (start, end). A new island begins when the gap to the
    previous spell is at least ``window.gap_days``. With ``rule="pairwise"`` the
    gap is measured to the previous spell's own end and an island ends with its
    last spell's end (so a short spell nested in a long one can close the
    island early); ``rule="running_max"`` measures against the furthest end
    seen so far. Entry is clamped up to the window start, an exit after the
    window end becomes the open-end sentinel, and islands are numbered by their
    unclamped dates. Spell ends must not be null (use the open-end sentinel).

    One path serves every person, however many spells it has: the spells of a
    (person, start day) are summed up first, combined before the shuffle, and
    the window by person then composes one summary per start day (see
    ``_day_summaries``). So the window is bounded by the calendar, not by
    the data, and the input is read once.
    """
    if rule not in ("pairwise", "running_max"):
        raise ValueError(f"unknown rule {rule!r}")
    spells = rows.select(F.col(person).alias("person_id"), F.col(start).alias("s"), F.col(end).alias("e"))
    # Two islands can only coincide on malformed spells (end < start); keep one.
    islands = _islands(_day_summaries(spells, window.gap_days), window.gap_days, rule).distinct()
    numbered = Window.partitionBy("person_id").orderBy("s", "e")
    return islands.select(
        "person_id",
        F.when(F.col("s") < F.lit(window.start), F.lit(window.start)).otherwise(F.col("s")).alias("entry_dt"),
        F.when(F.col("e") > F.lit(window.end), F.lit(OPEN_END)).otherwise(F.col("e")).alias("exit_dt"),
        F.row_number().over(numbered).cast("int").alias("rw_seq"),
    )


def _island_end(rule: str):
    if rule == "pairwise":
        # End of the island's last spell in (start, end) order: the maximum of
        # (start, end) packed into one long keeps this a hash aggregate.
        return _unpack_end(F.max(_pack(F.col("s"), F.col("e"))))
    return F.max("e")


def _day_summaries(spells: DataFrame, gap: int) -> DataFrame:
    """(person_id, s, ends, last): what the spells that start on one day do to the chain.

    Inside a day the spells follow by end, and one opens an island if the end
    before it lies ``gap`` days or more before the day. Only malformed spells
    end so early. All others of the day join into one: they need their last
    end alone. So ``ends`` holds, in order, the early ends and then the last of
    the others; for well-formed spells that is one date. Of copies of an early
    spell three count: the second closes the island of the first and opens its
    own, a third adds an island of that one spell, and further ones repeat it.
    """
    early = F.date_diff(F.col("s"), F.col("e")) >= gap
    counted = spells.groupBy("person_id", "s", F.when(early, F.col("e")).alias("early")).agg(
        F.max("e").alias("e"), F.count(F.lit(1)).alias("copies")
    )
    copies = F.when(F.col("early").isNull(), 1).otherwise(F.least("copies", F.lit(3))).cast("int")
    # From here on everything lies with its person; a row a start day and early end is left.
    return (
        counted.repartition("person_id")
        .groupBy("person_id", "s")
        .agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("e", copies)))).alias("ends"), F.max("e").alias("last"))
    )


def _islands(days: DataFrame, gap: int, rule: str) -> DataFrame:
    """(person_id, s, e) islands from the summaries of a person's start days, composed in order."""
    ordered = Window.partitionBy("person_id").orderBy("s")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("last").over(ordered) if rule == "pairwise" else F.max("last").over(earlier)

    def opens(end, i):
        own = F.get("ends", i - 1)
        previous = F.coalesce(own, F.col("before")) if rule == "pairwise" else F.greatest(own, "before")
        return previous.isNull() | F.coalesce(F.date_diff(F.col("s"), previous) >= gap, F.lit(False))

    days = days.withColumn("before", before).withColumn("opens", F.transform("ends", opens))
    opened = F.size(F.filter("opens", lambda x: x))
    days = days.withColumn("offset", F.coalesce(F.sum(opened).over(earlier), F.lit(0)))
    spells = days.select("person_id", "s", "opens", "offset", F.posexplode("ends").alias("i", "e"))
    number = F.col("offset") + F.size(F.filter(F.slice("opens", 1, F.col("i") + 1), lambda x: x))
    return (
        spells.groupBy("person_id", number.alias("island")).agg(F.min("s").alias("s"), _island_end(rule).alias("e")).drop("island")
    )
