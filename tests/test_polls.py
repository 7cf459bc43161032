"""Runs, durations and histories against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltlake.operators import history, polls

START = dt.datetime(2021, 10, 1)
SCHEMA = "id_chargingpoint string, query_time timestamp, status_cp string"
STATUSES = ["CHARGING", "CHARGING", "AVAILABLE", None]


def random_facts(seed, n=900, days=9):
    """A third of the polls are of one id; some ids skip days, some polls share a time."""
    draw, rows = random.Random(seed), []
    for k in range(n):
        who = "hot" if k % 3 == 0 else draw.choice("abcdefg")
        day = draw.choice([0, 4, 8]) if who == "a" else draw.randrange(days)
        minute = draw.randrange(0, 1440, 30 if who == "hot" else 7)
        status = "CHARGING" if who == "b" else draw.choice(STATUSES)
        rows.append((who, START + dt.timedelta(days=day, minutes=minute), status))
    return rows


def ordered(rows):
    by_id = {}
    for who, time, status in rows:
        times = by_id.setdefault(who, {})
        times[time] = times.get(time, False) or status == "CHARGING"
    return {who: sorted(times.items()) for who, times in by_id.items()}


def expected_events(rows):
    out = []
    for who, seen in ordered(rows).items():
        run = []
        for time, active in [*seen, (None, False)]:
            if active:
                run.append(time)
            elif run:
                out.append((who, run[0], run[-1], time, len(run)))
                run = []
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_events_equal_a_walk_through_the_polls(spark, seed):
    rows = random_facts(seed)
    found = polls.charging_events(spark.createDataFrame(rows, SCHEMA), "id_chargingpoint", "status_cp")
    assert found.columns == ["id_chargingpoint", "event_start", "event_end", "ended", "n_polls"]
    events = sorted(map(tuple, found.collect()))
    assert events == expected_events(rows)
    b = [e for e in events if e[0] == "b"]
    assert len(b) == 1 and b[0][3] is None  # charging all the time, over all days


def test_no_window_holds_an_ids_history(spark):
    """Of the windows over polls every one is by id and day; those by id alone see a day's summary or its border runs."""
    facts = spark.createDataFrame(random_facts(1), SCHEMA)
    days = facts.select("id_chargingpoint", F.to_date("query_time")).distinct().count()
    marked = polls.polls(facts, "id_chargingpoint", F.col("status_cp") == "CHARGING")
    assert marked.count() == facts.select("id_chargingpoint", "query_time").distinct().count() > 4 * days


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert polls.charging_events(none, "id_chargingpoint", "status_cp").count() == 0
    odd = spark.createDataFrame([(None, START, "CHARGING"), ("a", None, "CHARGING"), ("a", START, None)], SCHEMA)
    assert polls.charging_events(odd, "id_chargingpoint", "status_cp").count() == 0


def expected_time(rows, start, end, longest=None):
    out = {}
    for who, seen in ordered(rows).items():
        seen = [(t, a) for t, a in seen if t < end]
        for (time, active), until in zip(seen, [t for t, _ in seen[1:]] + [end]):
            until = min(until, end, time + longest) if longest else min(until, end)
            seconds = max(0.0, (until - max(time, start)).total_seconds())
            total = out.setdefault(who, [0.0, 0.0])
            total[1] += seconds
            total[0] += seconds if active else 0.0
    return out


@pytest.mark.parametrize("longest", [None, 3600])
def test_time_weights_equal_a_walk_through_the_polls(spark, longest):
    rows = random_facts(3)
    start, end = START + dt.timedelta(days=1, hours=5), START + dt.timedelta(days=6, hours=7, minutes=3)
    found = polls.active_time(
        spark.createDataFrame(rows, SCHEMA), "id_chargingpoint", F.col("status_cp") == "CHARGING", str(start), str(end), longest
    )
    got = {r[0]: [r["active_micros"] / 1e6, r["observed_micros"] / 1e6] for r in found.collect()}
    assert got == expected_time(rows, start, end, longest and dt.timedelta(seconds=longest))


def test_looking_back_is_bounded(spark):
    rows = [("a", START, "CHARGING"), ("b", START + dt.timedelta(days=4, hours=23), "CHARGING")]
    find = lambda **o: {r[0]: r["active_micros"] / 1e6 for r in polls.active_time(
        spark.createDataFrame(rows, SCHEMA), "id_chargingpoint", F.col("status_cp") == "CHARGING",
        str(START + dt.timedelta(days=5)), str(START + dt.timedelta(days=6)), **o).collect()}
    assert find() == {"a": 86400.0, "b": 86400.0} and find(look_back_days=1) == {"b": 86400.0}


def test_a_station_counts_once_for_a_category(spark):
    rows = [("a", START, "CHARGING"), ("b", START, "AVAILABLE"), ("c", START, "CHARGING")]
    points = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id_cp string, id_cs int")
    mapping = spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "id_poi string, id_cs int")
    poi = spark.createDataFrame([("x", "mall"), ("y", "mall"), ("z", "fuel")], "id_poi string, poi_category string")
    found = polls.utilization_by_poi(
        spark.createDataFrame(rows, SCHEMA), points, mapping, poi, "2021-10-01 00:00:00", "2021-10-01 01:00:00"
    ).collect()
    got = {r["poi_category"]: (r["n_stations"], r["n_points"], r["active_seconds"], r["utilization"]) for r in found}
    assert got == {"mall": (1, 2, 3600.0, 0.5), "fuel": (1, 2, 3600.0, 0.5), None: (1, 1, 3600.0, 1.0)}


def test_rollup_adds_up(spark):
    rows = [("a", START, "CHARGING"), ("a", START + dt.timedelta(hours=1), "AVAILABLE"), ("b", START, "AVAILABLE"), ("lost", START, "CHARGING")]
    points = spark.createDataFrame([("a", 1), ("b", 2)], "id_cp string, id_cs int")
    stations = spark.createDataFrame([(1, "Bonn", "X"), (2, "Hof", "X")], "id_cs int, city string, operator_name string")
    found = polls.utilization_rollup(
        spark.createDataFrame(rows, SCHEMA), points, stations, "2021-10-01 00:00:00", "2021-10-01 04:00:00"
    ).collect()
    got = {(r["level"], r["operator_name"], r["city"], r["id_cs"]): (r["n_points"], r["active_seconds"], r["utilization"]) for r in found}
    assert got[(0, "X", "Bonn", 1)] == (1, 3600.0, 0.25)
    assert got[(1, "X", "Hof", None)] == (1, 0.0, 0.0)
    assert got[(3, "X", None, None)] == (2, 3600.0, 0.12)
    assert got[(0, None, None, None)] == (1, 14400.0, 1.0)
    assert got[(7, None, None, None)] == (3, 18000.0, 0.42)


# ---- history -----------------------------------------------------------------------------

STATES = "id int, seen timestamp, name string, n int"


def random_states(seed, n=500):
    draw = random.Random(seed)
    return [
        (k % 3 if k % 2 else draw.randrange(3, 12), START + dt.timedelta(hours=draw.randrange(400)), draw.choice(["x", "x", "y", None]), 1)
        for k in range(n)
    ]


def expected_intervals(states):
    by_id = {}
    for i, time, name, n in states:
        by_id.setdefault(i, []).append((time, name, n))
    out = []
    for i, seen in by_id.items():
        stretches = []
        for time, name, n in sorted(seen, key=lambda s: s[0]):
            if stretches and stretches[-1][0] == (name, n):
                stretches[-1][2] = time
            else:
                stretches.append([(name, n), time, time])
        for stretch, following in zip(stretches, [*stretches[1:], None]):
            out.append((i, *stretch[0], stretch[1], following and following[1], stretch[2]))
    return sorted(out, key=str)


def shown(df):
    return sorted(map(tuple, df.select("id", "name", "n", "valid_from", "valid_to", "last_seen").collect()), key=str)


def one_state_a_time(seed):
    return list({(i, t): (i, t, name, n) for i, t, name, n in random_states(seed)}.values())


def test_intervals_equal_a_walk_through_the_states(spark):
    states = one_state_a_time(4)
    found = history.intervals(spark.createDataFrame(states, STATES), "id", "seen", ["name", "n"])
    assert shown(found) == expected_intervals(states)
    assert found.groupBy("id").agg(F.count_if(F.col("valid_to").isNull()).alias("open")).where("open <> 1").count() == 0


def test_two_halves_equal_one_load(spark):
    states = one_state_a_time(6)
    df = spark.createDataFrame(states, STATES)
    early = F.col("seen") < F.lit(str(START + dt.timedelta(hours=170))).cast("timestamp")
    first = history.intervals(df.where(early), "id", "seen", ["name", "n"])
    both = history.extend_history(first, df.where(~early), "id", "seen", ["name", "n"])
    assert both.columns == first.columns and shown(both) == expected_intervals(states)
    # The same rows once more change nothing, nor does a load without rows.
    assert shown(history.extend_history(both, df.where(~early), "id", "seen", ["name", "n"])) == shown(both)
    assert shown(history.extend_history(both, df.where("false"), "id", "seen", ["name", "n"])) == shown(both)


def test_a_late_row_splits_what_was_known(spark):
    rows = [(1, START, "x", 1), (1, START + dt.timedelta(hours=9), "x", 1)]
    known = history.intervals(spark.createDataFrame(rows, STATES), "id", "seen", ["name", "n"])
    late = spark.createDataFrame([(1, START + dt.timedelta(hours=4), "y", 1)], STATES)
    grown = history.extend_history(known, late, "id", "seen", ["name", "n"])
    assert shown(grown) == expected_intervals([*rows, (1, START + dt.timedelta(hours=4), "y", 1)])


def test_ties_and_nulls(spark):
    rows = [(1, START, "x", 1), (1, START, "y", 1), (1, START, "x", 1), (None, START, "x", 1), (2, None, "x", 1)]
    found = history.intervals(spark.createDataFrame(rows, STATES), "id", "seen", ["name", "n"]).collect()
    again = history.intervals(spark.createDataFrame(rows[::-1], STATES), "id", "seen", ["name", "n"]).collect()
    assert len(found) == 1 and found == again
