import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from flowloom.operators import history

BASE = date(2024, 1, 1)


def fold(seen, keys, expiry):
    """The plain day-by-day rule over days with input."""
    state, out = {}, []
    for day in sorted({d for d, *_ in seen}):
        today = {tuple(k) for d, *k in seen if d == day}
        hosts = {k[0] for k in today}
        for k in today:
            first, _, count = state.get(k, (day, day, 0))
            state[k] = (first, day, count)
        state = {k: v for k, v in state.items() if (day - v[1]).days < expiry}
        state = {k: (f, l, c + (k[0] in hosts)) for k, (f, l, c) in state.items()}
        out += [(day, *k, f, l, c, (day - f).days, (day - l).days) for k, (f, l, c) in state.items()]
    return sorted(out)


def replayed(spark, seen, expiry):
    df = spark.createDataFrame(seen, "day date, host string, site string")
    out = history.history_replay(df, ["host", "site"], expiry=expiry)
    cols = ["day", "host", "site", "firstseen_date", "lastseen_date", "count_since_firstseen", "days_since_firstseen", "days_since_lastseen"]
    return sorted(tuple(r) for r in out.select(*cols).collect())


def test_edges_of_the_expiry(spark):
    for idle in (29, 30, 31):
        seen = [(BASE, "h", "s"), (BASE + timedelta(days=idle), "h", "s")]
        seen += [(BASE + timedelta(days=i), "daily", "s") for i in range(idle + 1)]
        got = replayed(spark, seen, 30)
        assert got == fold(seen, 2, 30)
        last = [r for r in got if r[1] == "h"][-1]
        assert last[3] == (BASE if idle < 31 else BASE + timedelta(days=idle))


def test_replay_equals_the_fold(spark):
    rng = random.Random(11)
    seen = set()
    days = sorted(rng.sample(range(40), 25))  # some days without input
    for host in "abcdef":
        for site in "xy":
            for d in days:
                if rng.random() < 0.2:
                    seen.add((BASE + timedelta(days=d), host, site))
    for expiry in (1, 3, 5, 30):
        assert replayed(spark, sorted(seen), expiry) == fold(seen, 2, expiry)


def test_steps_equal_the_replay(spark):
    rng = random.Random(12)
    seen = sorted({(BASE + timedelta(days=d), h, s) for d in range(8) for h in "abc" for s in "xy" if rng.random() < 0.3})
    keys = ["host", "site"]
    state = history.empty_history(spark, keys)
    cols = ["host", "site", "firstseen_date", "lastseen_date", "count_since_firstseen", "days_since_firstseen", "days_since_lastseen"]
    got = []
    for day in sorted({d for d, *_ in seen}):
        today = spark.createDataFrame([(h, s) for d, h, s in seen if d == day], "host string, site string")
        rows = history.history_step(state, today, day, keys, expiry=3).collect()
        state = spark.createDataFrame(rows, history.empty_history(spark, keys).schema)
        got += [(day, *[r[c] for c in cols]) for r in rows]
    assert sorted(got) == fold(seen, 2, 3)


def test_log_types_and_addresses(spark):
    keys = ["server_name", "anon_resp"]
    before = history.history_step(
        history.empty_history(spark, keys), spark.createDataFrame([("::1", "s")], "server_name string, anon_resp string"),
        BASE, keys, "HTTP",
    )
    after = history.history_step(before, spark.createDataFrame([("::1", "s")], "server_name string, anon_resp string"),
                                 BASE + timedelta(days=1), keys, "SSL").first()
    assert (after.firstseen_log_type, after.lastseen_log_type, after.isIP, after.count_since_firstseen) == ("HTTP", "SSL", 1, 2)


def test_daily_hosts_drop_nulls_and_name_blanks(spark):
    df = spark.createDataFrame(
        [("h", "1.1.1.1", "s"), ("h", "2.2.2.2", "s"), (None, "1.1.1.1", "s"), ("", "3.3.3.3", "s"), ("h", "1.1.1.1", None)],
        "host string, id_resp_h string, anon_host string",
    )
    assert sorted(tuple(r) for r in history.daily_hosts(df).collect()) == [("h", "s"), ("missing_3.3.3.3", "s")]


def test_continued_from_a_stored_state_equals_the_steps(spark):
    """From any day's state, over days on which nothing is seen and keys that went out of the table of dates."""
    rng = random.Random(13)
    keys = ["host", "site"]
    cols = [*keys, "firstseen_date", "lastseen_date", "firstseen_log_type", "lastseen_log_type", "count_since_firstseen", "days_since_firstseen", "days_since_lastseen", "isIP"]
    seen = sorted({(BASE + timedelta(days=d), h, s) for d in range(12) for h in "abcde" for s in "xy" if rng.random() < 0.2 and d != 5})
    # The calendar has a day on which nothing is seen, and two without input.
    calendar = [BASE + timedelta(days=d) for d in range(12) if d not in (3, 8)]
    for expiry in (2, 3):
        schema = history.empty_history(spark, keys).schema
        states, state = {}, history.empty_history(spark, keys)
        for day in calendar:
            today = spark.createDataFrame([k[1:] for k in seen if k[0] == day], "host string, site string")
            state = spark.createDataFrame(history.history_step(state, today, day, keys, "SSL" if day < calendar[4] else "HTTP", expiry).collect(), schema)
            states[day] = sorted(tuple(r[c] for c in cols) for r in state.collect())
        for at in (None, calendar[3]):
            later = [d for d in calendar if at is None or d > at]
            rows = [] if at is None else states[at]
            begin = spark.createDataFrame([dict(zip(cols, r)) for r in rows], schema) if rows else history.empty_history(spark, keys)
            known = spark.createDataFrame([k for k in seen if k[0] in later], "day date, host string, site string")
            kind = "HTTP" if at else "SSL"
            got = history.history_continued(begin, known, later, keys, log_type=kind, expiry=expiry).collect()
            for day in later:
                if at or day < calendar[4]:
                    assert sorted(tuple(r[c] for c in cols) for r in got if r.day == day) == states[day]
    old = spark.createDataFrame([("h", "s", date(2020, 1, 1), date(2020, 1, 2), "HTTP", "HTTP", 5, 1, 1, 0)], schema)
    none = spark.createDataFrame([], "day date, host string, site string")
    assert history.history_continued(old, none, calendar, keys).count() == 0
