import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import intervals

DAY = dt.timedelta(days=1)


def day(n):
    return dt.date(2020, 1, 1) + n * DAY


def eras_by_hand(rows, window, person_end=True):
    """Rows are (person, concept, start, end); the semantics row by row."""
    first, last = {}, {}
    for person, _, start, end in rows:
        if start and person is not None:
            first[person] = min(first.get(person, start), start)
        if end and person is not None:
            last[person] = max(last.get(person, end), end)
    filled = []
    for person, concept, start, end in rows:
        begin = start or first.get(person) or (end - 30 * DAY if end else None)
        filled.append([person, concept, start is None, begin, end])
    known = sorted(r[3] for r in filled if r[3])
    half = len(known) // 2
    if known:
        low = known[half] if len(known) % 2 else known[half - 1]
        median = low + dt.timedelta(days=(known[half] - low).days // 2)
    groups = {}
    for person, concept, late, start, end in filled:
        start = start or median
        end = end or (last.get(person) if person_end else None) or start + 30 * DAY
        if person is not None and concept is not None:
            groups.setdefault((person, concept), []).append((late, start, end))
    found = set()
    for key, group in groups.items():
        begin = before = None
        for _, start, end in sorted(group):
            if before is None or (start - before).days > window:
                if before is not None:
                    found.add((*key, begin, before))
                begin = start
            before = end
        found.add((*key, begin, before))
    return found


def facts(spark, rows, name="drug"):
    stem = "drug_exposure" if name == "drug" else name
    ddl = f"person_id long, {name}_concept_id long, {stem}_start_date date, {stem}_end_date date"
    return spark.createDataFrame(rows, ddl)


THREE = [
    (1, 7, dt.date(2020, 1, 1), dt.date(2020, 1, 10)),
    (1, 7, dt.date(2020, 1, 15), dt.date(2020, 1, 20)),
    (1, 7, dt.date(2020, 3, 1), dt.date(2020, 3, 10)),
]


def test_two_eras_from_three_rows(spark):
    for name, build in (("drug", intervals.drug_eras), ("condition", intervals.condition_eras)):
        out = build(facts(spark, THREE, name)).collect()
        dates = {(r[f"{name}_era_start_date"], r[f"{name}_era_end_date"]) for r in out}
        assert dates == {
            (dt.date(2020, 1, 1), dt.date(2020, 1, 20)),
            (dt.date(2020, 3, 1), dt.date(2020, 3, 10)),
        }


def test_dose_eras_split_by_dose(spark):
    rows = [
        (1, 7, dt.date(2020, 1, 1), dt.date(2020, 1, 5), 5.0, 1),
        (1, 7, dt.date(2020, 1, 10), dt.date(2020, 1, 12), 5.0, 1),
        (1, 7, dt.date(2020, 1, 15), dt.date(2020, 1, 20), 10.0, 1),
    ]
    df = spark.createDataFrame(
        rows,
        "person_id long, drug_concept_id long, drug_exposure_start_date date, "
        "drug_exposure_end_date date, quantity double, dose_unit_concept_id long",
    )
    assert intervals.dose_eras(df).count() == 2
    without = intervals.dose_eras(df.drop("quantity", "dose_unit_concept_id")).collect()
    assert [(r.dose_value, r.unit_concept_id) for r in without] == [(1.0, 0)]


@pytest.mark.parametrize("gap, eras", [(30, 1), (31, 2)])
def test_window_is_inclusive(spark, gap, eras):
    rows = [(1, 1, day(0), day(5)), (1, 1, day(5 + gap), day(50))]
    assert intervals.drug_eras(facts(spark, rows)).count() == eras


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("name", ["drug", "condition"])
def test_eras_equal_row_by_row(spark, seed, name):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        start = rng.choice([None, *range(0, 400, 7)])
        length = rng.choice([0, 1, 5, 20, -3, -40, -80, 200])
        end = None if rng.random() < 0.15 else day((start or rng.randrange(400)) + length)
        person = rng.choice([None, 1, 2, 3, 4, 5])
        concept = rng.choice([None, 1, 2])
        rows.append((person, concept, None if start is None else day(start), end))
    rows.append((99, 1, None, None))
    rows += [(98, 1, None, day(100)), (98, 1, None, day(60))]
    build = intervals.drug_eras if name == "drug" else intervals.condition_eras
    out = build(facts(spark, rows, name), window=20).collect()
    got = {tuple(r)[1:] for r in out}
    assert len(out) == len(got)
    assert got == eras_by_hand(rows, 20, person_end=name == "drug")


def test_equal_inverted_rows_keep_their_eras(spark):
    rows = [(1, 1, day(0), day(10))] + [(1, 1, day(100), day(20))] * 5 + [(1, 1, day(101), day(120))]
    out = intervals.drug_eras(facts(spark, rows), window=30, fill=False).collect()
    assert {tuple(r)[1:] for r in out} == eras_by_hand(rows, 30)


def test_running_max(spark):
    rows = [(1, 1, day(0), day(300)), (1, 1, day(10), day(12)), (1, 1, day(100), day(110))]
    assert intervals.drug_eras(facts(spark, rows)).count() == 2
    assert intervals.drug_eras(facts(spark, rows), running_max=True).count() == 1


def test_hot_group_reaches_the_window_as_calendar_days(spark):
    rows = spark.range(200_000).select(
        F.lit(1).cast("long").alias("person_id"),
        F.lit(1).cast("long").alias("drug_concept_id"),
        F.date_add(F.lit(day(0)), (F.col("id") % 500).cast("int")).alias("s"),
    )
    df = rows.withColumn("e", F.date_add("s", 3)).withColumn("_late", F.lit(0))
    slices = intervals._day_slices(df, ["person_id", "drug_concept_id"], "s", "e", 30)
    assert slices.count() == 500


def visits_by_hand(rows, gap):
    groups = {}
    for person, start, stop, source, provider in rows:
        if person is not None:
            groups.setdefault(person, []).append((start.date(), start, stop, source, provider))
    out = set()
    for person, group in groups.items():
        current = None
        for _, start, stop, source, provider in sorted(group, key=lambda r: r[:4]):
            if current is None or (start - before).days > gap:
                if current:
                    out.add((person, *current))
                current = [start, stop, source, provider]
            else:
                current[0] = min(current[0], start)
                current[1] = max(current[1], stop)
                current[3] = current[3] or provider
            before = stop
        out.add((person, *current))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("gap", [0, 1, 3])
def test_visits_equal_row_by_row(spark, seed, gap):
    rng = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(300):
        start = base + dt.timedelta(minutes=rng.randrange(0, 200 * 1440, 30))
        stop = start + dt.timedelta(minutes=rng.choice([0, 30, 300, 1440, 2880, 9000]))
        rows.append((rng.choice([None, 1, 2, 3, 4]), start, stop, f"e{i:04d}", rng.choice([None, "x", "y"])))
    df = spark.createDataFrame(
        rows, "p long, start timestamp_ntz, stop timestamp_ntz, id string, provider string"
    )
    out = intervals.collapse_visits(df, ["p"], "start", "stop", "id", ["provider"], gap).collect()
    assert {tuple(r) for r in out} == visits_by_hand(rows, gap)


@pytest.mark.parametrize("minutes, visits", [(48 * 60 - 1, 1), (48 * 60, 2)])
def test_visit_gap_counts_whole_days(spark, minutes, visits):
    stop = dt.datetime(2020, 1, 1, 12)
    rows = [(1, stop, stop, "a"), (1, *[stop + dt.timedelta(minutes=minutes)] * 2, "b")]
    df = spark.createDataFrame(rows, "p long, start timestamp_ntz, stop timestamp_ntz, id string")
    assert intervals.collapse_visits(df, ["p"], "start", "stop", "id").count() == visits


def test_row_level_lag_and_session(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3), day(s), day(s + rng.randrange(3)), i)
            for i, s in enumerate(rng.choices(range(0, 300, 9), k=200))]
    df = spark.createDataFrame(rows, "k int, s date, e date, id int")
    lagged = intervals.previous_end(df, ["k"], "s", "e", "id")
    numbered = intervals.session_number(df, ["k"], "s", "e", 10)
    previous = {r.id: r.previous_end for r in lagged.collect()}
    session = {r.id: r.session for r in numbered.collect()}
    for k in range(3):
        before, count = None, 0
        for _, s, e, i in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]):
            assert previous[i] == before
            count += before is None or (s - before).days > 10
            assert session[i] == count
            before = e


def test_fill_from_group(spark):
    rows = [(1, day(5), day(9)), (1, None, day(7)), (1, day(6), None), (2, None, None), (None, None, day(1))]
    df = spark.createDataFrame(rows, "p long, s date, e date")
    out = {tuple(r) for r in intervals.fill_from_group(df, "p", "s", "e").collect()}
    assert out == {(1, day(5), day(9)), (1, day(5), day(7)), (1, day(6), day(9)),
                   (2, None, None), (None, None, day(1))}


def test_median_is_cut_to_a_day(spark):
    df = spark.createDataFrame([(day(0),), (day(3),), (None,)], "s date")
    assert intervals.median_day(df, "s").first().median_day == day(1)


@pytest.mark.parametrize("copies", [1, 2, 3, 4, 50])
@pytest.mark.parametrize("counted", [False, True])
def test_equal_closing_rows_give_an_era_each(spark, copies, counted):
    """One era per row that opens one, also where equal rows come as a number."""
    closing = (1, 1, day(100), day(20))
    others = [(1, 1, day(0), day(10)), (1, 1, day(101), day(120))]
    data = facts(spark, others + [closing] * copies)
    if counted:
        data = intervals.drug_spans(data)
    names = ["drug_exposure_start_date", "drug_exposure_end_date"]
    out = intervals.collapse_eras(data, ["person_id", "drug_concept_id"], *names, window=30).collect()
    found, begin, before = [], None, None
    for _, _, start, end in sorted(others + [closing] * copies, key=lambda r: r[2:]):
        if before is None or (start - before).days > 30:
            if before is not None:
                found.append((begin, before))
            begin = start
        before = end
    found.append((begin, before))
    assert sorted((r.era_start, r.era_end) for r in out) == sorted(found)


def test_fills_read_the_facts_twice_and_stage_only_sums(spark, tmp_path):
    """Once for bounds, day counts and gaps, which are staged, and once for the complete rows."""
    path = str(tmp_path / "facts")
    rows = [(i % 50, i % 7, day(i % 900), day(i % 900 + i % 40)) for i in range(5000)]
    rows += [(i % 50, 1, day(i % 9), None) for i in range(90)]
    facts(spark, rows).write.parquet(path)
    given = spark.read.parquet(path)
    out = intervals.drug_eras(given)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    relations = [line for line in plan.splitlines() if "Relation [" in line]
    complete = [line for line in relations if "drug_exposure_start_date" in line and "_gap" not in line]
    assert len(complete) == 1
    bounds, by_day, gaps = intervals._looked_up(given, intervals.DRUG_KEYS, "person_id", *intervals.DRUG_DATES)
    assert (bounds.count(), by_day.count()) == (50, 900) and gaps.count() <= 90 and out.count() > 0


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("name", ["drug", "condition"])
def test_spans_of_parts_are_the_spans_of_the_whole(spark, seed, name):
    """Eras of the spans of random parts, some reduced again, equal those of the facts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        start = rng.choice([None, *range(0, 300, 5)])
        end = None if rng.random() < 0.2 else day((start or rng.randrange(300)) + rng.choice([0, 3, 9, -2, -50, 90]))
        rows.append((rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 1, 2]), None if start is None else day(start), end))
    rows += [(98, 1, None, day(100)), (99, 1, None, None)]
    build = intervals.drug_eras if name == "drug" else intervals.condition_eras
    spans = intervals.drug_spans if name == "drug" else intervals.condition_spans
    expected = sorted(map(str, build(facts(spark, rows, name), window=20).collect()))
    cuts = [rng.randrange(4) for _ in rows]
    parts = [spans(facts(spark, [r for r, c in zip(rows, cuts) if c == k], name)) for k in range(4)]
    both = parts[0].unionByName(parts[1])
    keys = intervals.DRUG_KEYS if name == "drug" else intervals.CONDITION_KEYS
    dates = intervals.DRUG_DATES if name == "drug" else intervals.CONDITION_DATES
    merged = intervals.era_spans(both, keys, *dates).unionByName(parts[2]).unionByName(parts[3])
    assert sorted(map(str, build(merged, window=20).collect())) == expected
