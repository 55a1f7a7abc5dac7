"""Interval operators: eras, visit collapse and the fills they need.

No window in this module runs over raw rows. A group (person and concept, say) is first
reduced by an ordinary aggregate to one row per calendar slice, which every task does before
the shuffle. What a window then sees of one group is bounded by the calendar and not by the
number of rows, so a group that holds a third of the table is no slower than the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.keys import joined_key, surrogate_id
from cohortloom.functions.parse import to_float
from cohortloom.functions.text import column_or_null, first_present, float_text
from cohortloom.operators.joins import keep_first, renewed
from cohortloom.session import staged

DAY_SECONDS = 86400


def _has_all(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


# --- fills -----------------------------------------------------------------------------


def group_bounds(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Earliest start and latest end of each group."""
    bounds = df.groupBy(key).agg(F.min(start).alias("_first"), F.max(end).alias("_last"))
    return bounds.select(renewed(df, key), "_first", "_last")


def fill_from_group(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Null starts take the group's earliest start, null ends its latest end.

    Only the rows with a gap are joined with the group bounds.
    """
    complete = F.col(start).isNotNull() & F.col(end).isNotNull()
    gaps = df.filter(~complete).join(group_bounds(df, key, start, end), key, "left")
    filled = gaps.withColumns(
        {start: F.coalesce(start, "_first"), end: F.coalesce(end, "_last")}
    ).select(df.columns)
    return df.filter(complete).unionByName(filled)


def _rows_of(df: DataFrame) -> Column:
    """How many rows a group has, where ``_n`` says what each row stands for."""
    return F.sum("_n") if "_n" in df.columns else F.count("*")


def era_spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Facts reduced to what eras depend on: spans with the number ``_n`` of facts behind each.

    Of the whole facts of a group that start on one day only the latest end counts, unless an end
    lies before its start. Those and facts that lack a date stay as they are. Spans of several
    parts of the facts are together the spans of the whole: they may be reduced again.
    """
    whole = F.coalesce(F.col(start) <= F.col(end), F.lit(False))
    own = F.when(~whole, F.col(end))
    spans = df.groupBy(*keys, start, whole.alias("_whole"), own.alias("_own"))
    return spans.agg(F.max(end).alias(end), _rows_of(df).alias("_n")).drop("_whole", "_own")


def median_day(df: DataFrame, day: str) -> DataFrame:
    """Median of a date column as one row, cut to a whole day.

    Counted per day first: the exact median is then taken over the calendar.
    """
    counts = df.filter(F.col(day).isNotNull()).groupBy(day).agg(_rows_of(df).alias("_n"))
    middle = F.percentile(F.unix_date(F.col(day)), F.lit(0.5), F.col("_n"))
    return counts.agg(F.date_from_unix_date(F.floor(middle).cast("int")).alias("median_day"))


def _looked_up(df: DataFrame, keys: Sequence[str], person: str, start: str, end: str) -> tuple[DataFrame, ...]:
    """Bounds of each person, facts by start day, and the distinct facts that lack a date.

    One pass over ``df``, summed three ways in every task; what is staged of it grows with the
    persons, the calendar and the gaps, not with the whole facts.
    """
    gap = F.col(start).isNull() | F.col(end).isNull()
    held = {name: F.when(gap, F.col(name)) for name in dict.fromkeys([person, *keys, start, end])}
    rows = df.select(
        F.col(person).alias("_person"), F.col(start).alias("_day"), gap.alias("_gap"),
        *[c.alias(f"_gap_{name}") for name, c in held.items()],
        F.col(start).alias("_start"), F.col(end).alias("_end"),
        (F.col("_n") if "_n" in df.columns else F.lit(1).cast("long")).alias("_n"),
    )
    gaps = ["_gap", *[f"_gap_{name}" for name in held]]
    sets = [["_person"], ["_day"], gaps]
    found = staged(
        rows.groupingSets(sets, "_person", "_day", *gaps).agg(
            F.min("_start").alias("_first"), F.max("_end").alias("_last"), F.sum("_n").alias("_n"),
            *[F.grouping(c).alias(f"_no{c}") for c in ("_person", "_day", "_gap")],
        )
    )
    bounds = found.filter("_no_person = 0").select(F.col("_person").alias(person), "_first", "_last")
    days = found.filter("_no_day = 0 AND _day IS NOT NULL").select(F.col("_day").alias(start), "_n")
    lacking = found.filter("_no_gap = 0 AND _gap")
    return bounds, days, lacking.select(*[F.col(f"_gap_{name}").alias(name) for name in held], "_n")


def fill_era_dates(
    df: DataFrame,
    keys: Sequence[str],
    person: str,
    start: str,
    end: str,
    days: int = 30,
    end_from_person: bool = True,
) -> DataFrame:
    """``keys`` and the dates an era needs, with ``_late`` = 1 for rows that came without a start.

    Start: the person's earliest start, else ``days`` before the end, else the median of all
    starts. End: the person's latest end (if asked for), else ``days`` after the start. Rows
    that are complete, normally nearly all, take no part in any join and are not staged.
    """
    bounds, by_day, gaps = _looked_up(df, keys, person, start, end)
    complete = F.col(start).isNotNull() & F.col(end).isNotNull()
    whole = df.filter(complete).withColumn("_late", F.lit(0))
    if "_n" not in df.columns:
        whole = whole.withColumn("_n", F.lit(1).cast("long"))
    gaps = gaps.join(bounds, person, "left")
    known = F.coalesce(F.col(start), F.col("_first"), F.date_sub(F.col(end), days))
    gaps = gaps.withColumns({"_late": F.col(start).isNull().cast("int"), start: known})
    late = gaps.filter("_late = 1").select(start, "_n")
    begin = F.coalesce(F.col(start), median_day(by_day.unionByName(late), start).scalar())
    gaps = gaps.withColumn(start, begin)
    last = [F.col("_last")] if end_from_person else []
    gaps = gaps.withColumn(end, F.coalesce(F.col(end), *last, F.date_add(F.col(start), days)))
    names = [*dict.fromkeys([person, *keys]), start, end, "_n", "_late"]
    return whole.select(*names).unionByName(gaps.select(*names))


# --- row-level gap and session ---------------------------------------------------------


def _slices(df: DataFrame, keys: Sequence[str], start: str, end: str, row_id: str) -> DataFrame:
    """One row per group and (start, end) pair, with the lowest row id of the pair."""
    return (
        df.filter(_has_all(keys))
        .groupBy(*keys, start, end)
        .agg(F.min(row_id).alias("_head"))
    )


def previous_end(
    df: DataFrame, keys: Sequence[str], start: str, end: str, row_id: str
) -> DataFrame:
    """Adds ``previous_end``: the end of the row before, by (start, end, row id), per group.

    Rows with equal dates follow each other, so only the first of them looks at another pair.
    ``start`` and ``end`` are dates without nulls.
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    before = _slices(df, keys, start, end, row_id).withColumn("_before", F.lag(end).over(order))
    joined = df.join(before, [*keys, start, end], "inner")
    return joined.withColumn(
        "previous_end", F.when(F.col(row_id) == F.col("_head"), F.col("_before")).otherwise(F.col(end))
    ).select(*df.columns, "previous_end")


def session_number(
    df: DataFrame, keys: Sequence[str], start: str, end: str, window: int = 30
) -> DataFrame:
    """Adds ``session``: running count of gaps over ``window`` days, per group, from 1.

    Needs repaired intervals (end not before start); rows that start on one day then always
    share a session, so the count runs over days.
    """
    if window < 0:
        raise ValueError("window must not be negative")
    days = (
        df.filter(_has_all(keys)).groupBy(*keys, start).agg(F.max(end).alias("_end"))
    )
    order = Window.partitionBy(*keys).orderBy(start)
    gap = F.datediff(F.col(start), F.lag("_end").over(order))
    numbered = days.withColumn("_new", (gap.isNull() | (gap > window)).cast("int"))
    running = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = numbered.select(*keys, start, running.alias("session"))
    return df.join(numbered, [*keys, start], "inner")


# --- eras ------------------------------------------------------------------------------


def _day_slices(
    df: DataFrame, keys: Sequence[str], start: str, end: str, window: int
) -> DataFrame:
    """Rows of a group reduced to what can change its eras.

    Rows that start on one day cannot open an era after each other, so one row with the
    latest end stands for them. The exception are ends more than ``window`` days before
    their start, which close an era each; they stay apart. Of ``n`` equal ones the first and
    the last may share an era with a neighbour; those between them, which all give the same
    era, are one row that counts ``_times``.
    """
    closing = F.when(F.datediff(F.col(start), F.col(end)) > window, F.col(end))
    slices = (
        df.filter(_has_all(keys))
        .groupBy(*keys, "_late", start, closing.alias("_closing"))
        .agg(F.max(end).alias(end), _rows_of(df).alias("_copies"))
    )
    last = F.when(F.col("_copies") > 1, F.struct(F.lit(3).alias("copy"), F.lit(1).cast("long").alias("times")))
    between = F.when(F.col("_copies") > 2, F.struct(F.lit(2).alias("copy"), (F.col("_copies") - 2).alias("times")))
    first = F.struct(F.lit(1).alias("copy"), F.lit(1).cast("long").alias("times"))
    copies = F.when(F.col("_closing").isNull(), F.array(first)).otherwise(F.array_compact(F.array(first, between, last)))
    rows = slices.withColumn("_part", F.explode(copies))
    return rows.withColumns({"_copy": F.col("_part.copy"), "_times": F.col("_part.times")}).drop("_part")


def collapse_eras(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    window: int = 30,
    running_max: bool = False,
    copies: bool = True,
) -> DataFrame:
    """Eras as ``keys``, ``era_start``, ``era_end``.

    Ordered by start (rows that came without one last), a row opens an era when it starts
    more than ``window`` days after the end of the row before. The era runs from its first
    row's start to its last row's end. With ``running_max`` the latest end so far counts
    instead of the end of the row before. There is one era for each row that opens one; where
    ``df`` has a column ``_n``, a row stands for so many equal ones. Without ``copies`` equal eras that
    come from equal rows are given once.
    """
    if window < 0:
        raise ValueError("window must not be negative")
    if "_late" not in df.columns:
        df = df.withColumn("_late", F.lit(0))
    rows = _day_slices(df, keys, start, end, window)
    order = Window.partitionBy(*keys).orderBy("_late", start, end, "_copy")
    if running_max:
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn(end, F.max(end).over(so_far))
    gap_before = F.datediff(F.col(start), F.lag(end).over(order))
    gap_after = F.datediff(F.lead(start).over(order), F.col(end))
    rows = rows.withColumns({"_before": gap_before, "_after": gap_after})
    opens = F.col("_before").isNull() | (F.col("_before") > window)
    closes = F.col("_after").isNull() | (F.col("_after") > window)
    edges = rows.withColumns({"_opens": opens, "_closes": closes}).filter("_opens OR _closes")
    ends = F.when(F.col("_closes"), F.col(end)).otherwise(F.lead(end).over(order))
    opened = edges.withColumn("era_end", ends).filter("_opens")
    opened = opened.select(*keys, F.col(start).alias("era_start"), "era_end", "_times")
    if not copies:
        return opened.drop("_times")
    return opened.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).drop("_time", "_times")


def _with_era_id(eras: DataFrame, name: str, parts: Sequence[Column]) -> DataFrame:
    """Named era columns with the id hashed from them; equal eras are one era."""
    dates = [F.date_format(c, "yyyy-MM-dd") for c in ("era_start", "era_end")]
    keyed = eras.withColumn(
        f"{name}_era_id", surrogate_id(joined_key(*parts, *dates), f"{name} era")
    )
    return keyed.withColumnsRenamed(
        {"era_start": f"{name}_era_start_date", "era_end": f"{name}_era_end_date"}
    )


def _columns_of(name: str, keys: Sequence[str]) -> list[str]:
    return [f"{name}_era_id", *keys, f"{name}_era_start_date", f"{name}_era_end_date"]


def _finish(eras: DataFrame, name: str, keys: Sequence[str], parts: Sequence[Column]) -> DataFrame:
    columns = _columns_of(name, keys)
    keyed = _with_era_id(eras, name, parts).select(*columns)
    # Equal eras become one here, so they need no copies before.
    return keep_first(keyed, columns[0], columns[1:])


CONDITION_KEYS = ("person_id", "condition_concept_id")
CONDITION_DATES = ("condition_start_date", "condition_end_date")
DRUG_KEYS = ("person_id", "drug_concept_id")
DOSE_KEYS = (*DRUG_KEYS, "unit_concept_id", "dose_value")
DRUG_DATES = ("drug_exposure_start_date", "drug_exposure_end_date")


def condition_spans(conditions: DataFrame) -> DataFrame:
    """What condition eras depend on: keys, dates, number of facts."""
    start, end = CONDITION_DATES
    day = column_or_null(conditions, end, "date").alias(end)
    return era_spans(conditions.select(*CONDITION_KEYS, start, day), CONDITION_KEYS, start, end)


def condition_eras(
    conditions: DataFrame, window: int = 30, fill: bool = True, running_max: bool = False
) -> DataFrame:
    """Condition eras per person and concept, of facts or of their spans.

    ``fill=False`` skips the date fills for facts that are known to carry both dates.
    """
    keys, (start, end) = CONDITION_KEYS, CONDITION_DATES
    counted = ["_n"] if "_n" in conditions.columns else []
    facts = conditions.select(*keys, start, column_or_null(conditions, end, "date").alias(end), *counted)
    if fill:
        facts = fill_era_dates(facts, keys, "person_id", start, end, end_from_person=False)
    eras = collapse_eras(facts, keys, start, end, window, running_max, copies=False)
    return _finish(eras, "condition", keys, [F.col(k) for k in keys])


def drug_spans(exposures: DataFrame) -> DataFrame:
    """What drug eras depend on."""
    return era_spans(exposures.select(*DRUG_KEYS, *DRUG_DATES), DRUG_KEYS, *DRUG_DATES)


def drug_eras(
    exposures: DataFrame, window: int = 30, fill: bool = True, running_max: bool = False
) -> DataFrame:
    """Drug eras per person and concept, of facts or of their spans."""
    keys = DRUG_KEYS
    counted = ["_n"] if "_n" in exposures.columns else []
    facts = exposures.select(*keys, *DRUG_DATES, *counted)
    if fill:
        facts = fill_era_dates(facts, keys, "person_id", *DRUG_DATES)
    eras = collapse_eras(facts, keys, *DRUG_DATES, window, running_max, copies=False)
    return _finish(eras, "drug", keys, [F.col(k) for k in keys])


def dose_columns(exposures: DataFrame) -> dict[str, Column]:
    """Unit and dose of an exposure: ``dose_value``, else ``quantity``, else 1.0."""
    source = first_present(exposures, ["dose_value", "quantity"])
    dose = to_float(F.col(source)) if source else F.lit(None).cast("double")
    unit = column_or_null(exposures, "dose_unit_concept_id", "long")
    return {
        "unit_concept_id": F.coalesce(unit.cast("long"), F.lit(0)),
        "dose_value": F.coalesce(dose, F.lit(1.0)),
    }


def _doses(exposures: DataFrame) -> DataFrame:
    dose = [c.alias(name) for name, c in dose_columns(exposures).items()]
    return exposures.select(*DRUG_KEYS, *DRUG_DATES, *dose)


def dose_spans(exposures: DataFrame) -> DataFrame:
    """What dose eras depend on."""
    return era_spans(_doses(exposures), DOSE_KEYS, *DRUG_DATES)


def dose_eras(
    exposures: DataFrame, window: int = 30, fill: bool = True, running_max: bool = False
) -> DataFrame:
    """Dose eras per person, concept, unit and dose, of facts or of their spans."""
    keys = DOSE_KEYS
    facts = exposures if "_n" in exposures.columns else _doses(exposures)
    if fill:
        facts = fill_era_dates(facts, keys, "person_id", *DRUG_DATES)
    eras = collapse_eras(facts, keys, *DRUG_DATES, window, running_max, copies=False)
    parts = [float_text(F.col(k)) if k == "dose_value" else F.col(k) for k in keys]
    return _finish(eras, "dose", keys, parts)


# --- visits ----------------------------------------------------------------------------


def collapse_visits(
    encounters: DataFrame,
    keys: Sequence[str],
    start: str,
    stop: str,
    source_id: str,
    first_of: Sequence[str] = (),
    gap_days: int = 1,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Encounters of a group merged into visits.

    Ordered by start day, then by ``order``, an encounter opens a visit when the whole days
    since the end of the one before exceed ``gap_days``. A visit has the earliest start, the
    latest stop, the ``source_id`` of its first encounter and the first non-null value of
    each ``first_of`` column. Needs repaired intervals.

    Encounters that start in the same slice of ``gap_days + 1`` days never open a visit
    after each other, so slices are aggregated first and only slices are numbered.
    """
    if gap_days < 0:
        raise ValueError("gap_days must not be negative")
    width = gap_days + 1
    day = F.to_date(start)
    # ordering by the start orders by its day as well, any other order has to name the day
    rank = [day.alias("_day"), *map(F.col, order)] if order else [
        F.col(start), F.col(stop), F.col(source_id)
    ]
    carried = [F.col(start), F.col(stop), F.col(source_id)] if order else []
    row = F.struct(*rank, *carried)
    first_columns = {
        f"_first_{c}": F.min(F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c).alias("_v"))))
        for c in first_of
    }
    slices = (
        encounters.filter(_has_all(keys))
        .groupBy(*keys, F.floor(F.unix_date(day) / width).alias("_slice"))
        .agg(
            F.min(start).alias(start),
            F.max(stop).alias(stop),
            F.min(row).alias("_head"),
            F.max(row).alias("_tail"),
            *[c.alias(name) for name, c in first_columns.items()],
        )
    )
    ordered = Window.partitionBy(*keys).orderBy("_slice")
    seconds = F.timestamp_diff(
        "SECOND", F.lag(F.col("_tail")[stop]).over(ordered), F.col("_head")[start]
    )
    opens = F.coalesce(seconds >= width * DAY_SECONDS, F.lit(False)).cast("int")
    visit = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    numbered = slices.withColumn("_opens", opens).withColumn("_visit", visit)
    merged = numbered.groupBy(*keys, "_visit").agg(
        F.min(start).alias(start),
        F.max(stop).alias(stop),
        F.min("_head").alias("_head"),
        *[F.min(name).alias(name) for name in first_columns],
    )
    return merged.select(
        *keys,
        start,
        stop,
        F.col("_head")[source_id].alias(source_id),
        *[F.col(f"_first_{c}._v").alias(c) for c in first_of],
    )


def group_span(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """One row per group: earliest start and latest end, under their own names."""
    return df.groupBy(key).agg(F.min(start).alias(start), F.max(end).alias(end))
