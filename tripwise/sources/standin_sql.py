"""The stand-in views of ``standins`` written as DuckDB SQL, for oracle checks.

Each entry is the body of a common table expression over the driver's
tables (events, nation, region).
"""

from __future__ import annotations

from tripwise.sources.standins import BIKE_HEADER, fixed_centres

VIEWS: dict[str, str] = {}

VIEWS["trips"] = """select event_id as trip_id, user_id, cast(ts as date) as dt, strftime(ts, '%H:%M:%S') as time,
 hour(ts) as hh, minute(ts) as mi, second(ts) as ss,
 cast(floor(value*20) as double) as dur,
 40.5+((user_id*37)%400)/1000.0e0 as lat1, -74.2+((user_id*53)%450)/1000.0e0 as lon1,
 40.5+((user_id*37+event_id*29)%400)/1000.0e0 as lat2, -74.2+((user_id*53+event_id*31)%450)/1000.0e0 as lon2,
 cast(1+event_id%5 as double) as psg, cast(user_id as double) as id1, cast(event_id%150 as double) as id2,
 cast(1930+user_id%80 as double) as yr, cast(event_id%3 as double) as gdr
from events"""

VIEWS["weather"] = """select cast(ts as date) as dt, avg(value) as temp,
 sum(case when event_type='error' then 1 else 0 end)/100.0e0 as rain, min(value) as snow, max(value)/50.0e0 as wspd
from events where extract(day from ts)%10<>0 group by cast(ts as date)"""

VIEWS["raw_bike"] = f"""select event_id,
 case when event_id%17=0 then '{BIKE_HEADER}'
      when event_id%13=0 then replace(line, ',Customer', '')
      when event_id%7=0 then '"' || replace(line, ',', '","') || '"'
      else line end as line
from (select event_id,
 cast(cast(floor(value*20) as int) as varchar) || ',' ||
 (case when event_id%3=0 then cast(cast(ts as date) as varchar)
       else cast(month(ts) as varchar) || '/' || cast(day(ts) as varchar) || '/' || cast(year(ts) as varchar) end) || ' ' ||
 lpad(cast(hour(ts) as varchar),2,'0') || ':' || lpad(cast(minute(ts) as varchar),2,'0') ||
 (case when event_id%5=0 then '' else ':' || lpad(cast(cast(second(ts) as int) as varchar),2,'0') end) || ',stop,' ||
 cast(user_id as varchar) || ',start st,' ||
 cast(cast(40.5+((user_id*37)%400)/1000.0e0 as decimal(9,3)) as varchar) || ',' ||
 cast(cast(-74.2+((user_id*53)%450)/1000.0e0 as decimal(9,3)) as varchar) || ',' ||
 cast(event_id%150 as varchar) || ',end st,' ||
 cast(cast(40.5+((user_id*37+event_id*29)%400)/1000.0e0 as decimal(9,3)) as varchar) || ',' ||
 cast(cast(-74.2+((user_id*53+event_id*31)%450)/1000.0e0 as decimal(9,3)) as varchar) || ',' ||
 cast(event_id as varchar) || ',Customer,' ||
 (case when event_id%11=0 then '' when event_id%19=0 then 'NULL' else cast(1890+user_id%130 as varchar) end) || ',' ||
 cast(event_id%3 as varchar) as line
from events) q"""

VIEWS["raw_taxi"] = """select event_id, ts as pickup_ts,
 ts + to_seconds(cast(floor(value*20) as int)) as dropoff_ts,
 case when event_id%23=0 then null else 39.4+((user_id*37)%2300)/1000.0e0 end as pickup_latitude,
 -75.1+((user_id*53)%2300)/1000.0e0 as pickup_longitude,
 39.4+((user_id*37+event_id*29)%2300)/1000.0e0 as dropoff_latitude,
 -75.1+((user_id*53+event_id*31)%2300)/1000.0e0 as dropoff_longitude,
 1+event_id%5 as passenger_count, value/10.0e0 as trip_distance from events"""

VIEWS["zones"] = """select n_nationkey+1 as location_id, r_name as borough, n_name as zone,
 40.5+n_nationkey/100.0e0 as lat, -74.2+n_nationkey/100.0e0 as lon
 from nation join region on n_regionkey=r_regionkey
 union all
 select max(n_nationkey)+2, 'Unknown', 'Unknown', 38.876392e0, -77.0721696e0 from nation"""

VIEWS["trip_locations"] = "select event_id as trip_id, 1+event_id%30 as location_id from events"


def centres_values(n: int) -> str:
    rows = ", ".join(f"({k}, {lat!r}, {lon!r})" for k, (lat, lon) in enumerate(fixed_centres(n)))
    return f"select * from (values {rows}) as c(k, clat, clon)"


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} as ({VIEWS[n]})" for n in names]
    for n, q in (extra or {}).items():
        parts.append(f"{n} as ({q})")
    return "with " + ",\n".join(parts) + "\n" + body

VIEWS["raw_yellow"] = """select event_id, strftime(pickup_ts, '%Y-%m-%d %H:%M:%S') as tpep_pickup_datetime,
 strftime(dropoff_ts, '%Y-%m-%d %H:%M:%S') as tpep_dropoff_datetime, pickup_latitude, pickup_longitude,
 dropoff_latitude, dropoff_longitude, passenger_count, trip_distance from raw_taxi"""


def clean_taxi_sql(lon_box: tuple[float, float], lat_box: tuple[float, float], final: bool = True) -> str:
    """Cleaned taxi rows (P1-P3, F6-F9) over ``raw_taxi``."""
    p = """select event_id, strftime(pickup_ts, '%Y-%m-%d') as pck_date, strftime(pickup_ts, '%H:%M:%S') as pck_hms,
 date_diff('second', date_trunc('second', pickup_ts), date_trunc('second', dropoff_ts)) as Duration,
 pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude, passenger_count, trip_distance from raw_taxi"""
    if not final:
        return p
    box = (f"pickup_longitude < {lon_box[1]} and pickup_longitude > {lon_box[0]} and "
           f"dropoff_longitude < {lon_box[1]} and dropoff_longitude > {lon_box[0]} and "
           f"pickup_latitude < {lat_box[1]} and pickup_latitude > {lat_box[0]} and "
           f"dropoff_latitude < {lat_box[1]} and dropoff_latitude > {lat_box[0]}")
    return (f"select * from ({p}) p where Duration > 120 and Duration < 3600 and pickup_latitude is not null "
            f"and pickup_longitude is not null and dropoff_latitude is not null and dropoff_longitude is not null "
            f"and {box}")


def bike_fields_sql(header_prefixes: tuple[str, ...], keep_iso: bool) -> str:
    """Header drop, split, shape check, unquote, pick, date/time normalisation."""
    hdr = " and ".join(f"not starts_with(line, '{p}')" for p in header_prefixes)
    date = "split_part(f[2], ' ', 1)"
    parsed = f"strftime(try_strptime({date}, '%m/%d/%Y'), '%Y-%m-%d')"
    dt = f"case when contains({date}, '-') then {date} else {parsed} end" if keep_iso else parsed
    tm = "split_part(f[2], ' ', 2)"
    full = f"case when len(string_split({tm}, ':')) = 2 then {tm} || ':00' else {tm} end"
    time = f"strftime(try_strptime({full}, '%H:%M:%S'), '%H:%M:%S')"
    return f"""select event_id, {dt} as dt, {time} as time, f[1] as dur, f[4] as id1, f[6] as lat1, f[7] as lon1,
 f[8] as id2, f[10] as lat2, f[11] as lon2, f[14] as yr, f[15] as gdr from (
 select event_id, list_transform(f, lambda x: regexp_replace(regexp_replace(x, '^"', ''), '"$', '')) as f from (
  select event_id, string_split(rtrim(line, ','), ',') as f from raw_bike where {hdr}) a
 where len(f) = 15 and contains(f[2], ' ') and not list_contains(f, '')) b"""


SHAPE_SQL = ("dt is not null and time is not null and regexp_full_match(dur, '\\d+') and regexp_full_match(id1, '\\d+') "
             "and regexp_full_match(lat1, '\\d{2}.\\d+') and regexp_full_match(lon1, '-\\d{2}.\\d+') "
             "and regexp_full_match(id2, '\\d+') and regexp_full_match(lat2, '\\d{2}.\\d+') "
             "and regexp_full_match(lon2, '-\\d{2}.\\d+') and regexp_full_match(yr, '\\d+') "
             "and regexp_full_match(gdr, '\\d+')")
BOUNDS_SQL = ("try_cast(dur as int) between 120 and 3600 and try_cast(yr as int) between 1900 and 2010 "
              "and try_cast(lat1 as double) between 40.4774 and 40.9176 and try_cast(lon1 as double) between -74.2589 and -73.7004 "
              "and try_cast(lat2 as double) between 40.4774 and 40.9176 and try_cast(lon2 as double) between -74.2589 and -73.7004")
