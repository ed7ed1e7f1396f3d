"""Date parsing: strings generated together with the instant they mean, and literal rejects."""
import datetime as dt
import random

from pyspark.sql import functions as F

from curata.functions.dates import iso_or_rfc_date

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
ZONES = {"GMT": 0, "UT": 0, "UTC": 0, "Z": 0, "EST": -300, "EDT": -240, "PDT": -420, "CST": -360, "+0530": 330,
         "+0000": 0, "-0800": -480}
EPOCH = dt.datetime(1970, 1, 1)


def micros(d, minutes=0):
    return (d - dt.timedelta(minutes=minutes) - EPOCH) // dt.timedelta(microseconds=1)


def generated(rnd):
    """(text, microseconds it stands for)"""
    d = dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rnd.randrange(30 * 365 * 86400))
    fine = d + dt.timedelta(microseconds=rnd.choice([0, 5, 123000]))
    zone = rnd.choice(list(ZONES))
    mon = MONTHS[d.month - 1]
    day = rnd.choice(["", DAYS[d.weekday()] + ", "])
    return [
        (d.strftime("%Y-%m-%dT%H:%M:%SZ"), micros(d)),
        (fine.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), micros(fine)),
        (d.strftime("%Y-%m-%dT%H:%M:%S") + "+05:30", micros(d, 330)),
        (fine.strftime("%Y-%m-%dT%H:%M:%S.%f") + "-0800", micros(fine, -480)),
        (d.strftime("%Y-%m-%d %H:%M:%S"), micros(d)),
        (d.strftime("%Y-%m-%d"), micros(d.replace(hour=0, minute=0, second=0))),
        (f"{day}{d.day:02d} {mon} {d.year} {d.hour:02d}:{d.minute:02d}:{d.second:02d} {zone}", micros(d, ZONES[zone])),
        (f"  {day}{d.day} {mon} {d.year} {d.hour:02d}:{d.minute:02d} {zone}\t", micros(d.replace(second=0), ZONES[zone])),
    ]


REJECTS = ["Aug 15, 2026", "yesterday", "2026/08/15", "15.08.2026 10:00", "", "2026-13-01", "not a date"]


def test_generated_dates(spark):
    rnd = random.Random(20261202)
    cases = [c for _ in range(300) for c in generated(rnd)] + [(t, None) for t in REJECTS] + [(None, None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, s string")
    got = {r.i: r.u for r in df.select("i", F.unix_micros(iso_or_rfc_date("s")).alias("u")).collect()}
    bad = [(t, got[i], want) for i, (t, want) in enumerate(cases) if got[i] != want]
    assert not bad, bad[:10]
