"""Bike cleaning against a plain-Python model of the rules, on the raw stand-in
lines plus randomly damaged copies of them."""

import datetime as dtm
import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwise.operators import cleaning as cl
from tripwise.sources import standins as sv


def java_split(s, sep=","):
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def unq(w):
    if w.startswith('"'):
        w = w[1:]
    if w.endswith('"'):
        w = w[:-1]
    return w


def parse_date(text, keep_iso):
    if keep_iso and "-" in text:
        return text
    m = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4})", text)
    if not m:
        return None
    try:
        return dtm.date(int(m.group(3)), int(m.group(1)), int(m.group(2))).isoformat()
    except ValueError:
        return None


def parse_time(text):
    if len(text.split(":")) == 2:
        text += ":00"
    m = re.fullmatch(r"(\d{1,2}):(\d{1,2}):(\d{1,2})", text)
    if not m or int(m.group(1)) > 23 or int(m.group(2)) > 59 or int(m.group(3)) > 59:
        return None
    return "%02d:%02d:%02d" % tuple(int(g) for g in m.groups())


SHAPES = [r"\d+", r"\d+", r"\d{2}.\d+", r"-\d{2}.\d+", r"\d+", r"\d{2}.\d+", r"-\d{2}.\d+", r"\d+", r"\d+"]


def to_num(s, kind):
    try:
        v = kind(s)
    except ValueError:
        return None
    if kind is int and not -2**31 <= v < 2**31:
        return None
    return v


def clean_model(line, profile):
    if any(line.startswith(p) for p in profile.header_prefixes):
        return None
    f = java_split(line)
    if len(f) != 15 or " " not in f[1] or "" in f:
        return None
    f = [unq(w) for w in f]
    start = f[1].split(" ")
    d = parse_date(start[0], profile.keep_iso_dates)
    t = parse_time(start[1] if len(start) > 1 else "")
    picked = [f[i] for i in (0, 3, 5, 6, 7, 9, 10, 13, 14)]
    if d is None or t is None or not all(re.fullmatch(p, v) for p, v in zip(SHAPES, picked)):
        return None
    dur, yr = to_num(picked[0], int), to_num(picked[7], int)
    lats = [to_num(picked[i], float) for i in (2, 5)]
    lons = [to_num(picked[i], float) for i in (3, 6)]
    if None in (dur, yr, *lats, *lons):
        return None
    if not (120 <= dur <= 3600 and 1900 <= yr <= 2010 and all(40.4774 <= a <= 40.9176 for a in lats)
            and all(-74.2589 <= o <= -73.7004 for o in lons)):
        return None
    return (d, t, *picked)


def damage(line, rnd):
    ops = [lambda s: s.replace(",", ",,", 1), lambda s: s + ",", lambda s: s.replace("/", "-", 1),
           lambda s: s.replace(":", "", 1), lambda s: '"' + s, lambda s: s.replace("40.", "40x", 1),
           lambda s: s.replace(" ", "  ", 1), lambda s: s[: len(s) // 2], lambda s: s.replace("1/", "13/", 1)]
    return rnd.choice(ops)(line)


def test_clean_bike_matches_python_model(spark):
    raw = sv.raw_bike(sv.table(spark, SF_SMALL, "events")).collect()
    rnd = random.Random(5)
    lines = [(r["event_id"], r["line"]) for r in raw]
    lines += [(10_000_000 + i, damage(line, rnd)) for i, (_, line) in enumerate(lines)]
    df = spark.createDataFrame(lines, "event_id bigint, line string")
    for profile in (cl.BIKE_2015, cl.BIKE_2016):
        got = {tuple(r)[0]: tuple(r)[1:] for r in
               cl.clean_bike(df, profile).select("event_id", *cl.BIKE_OUT).collect()}
        want = {}
        for eid, line in lines:
            m = clean_model(line, profile)
            if m is not None:
                want[eid] = m
        assert got == want
        assert len(want) > 100
