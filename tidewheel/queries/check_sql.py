"""Common table expressions for the check SQL, written for a single-node SQL engine."""

from __future__ import annotations

_STAMP = "'^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}$'"
_FMT = "'%m/%d/%Y %H:%M'"

_FACT = """
    SELECT id AS fact_trip_id, id AS fact_trip_source_id, secs AS fact_trip_duration,
        st AS fact_trip_start_ts, et AS fact_trip_end_ts,
        CAST(st AS DATE) AS fact_trip_start_date_id, CAST(et AS DATE) AS fact_trip_end_date_id,
        CAST(hour(st) AS INT) AS fact_trip_start_hour, CAST(minute(st) AS INT) AS fact_trip_start_minute,
        CAST(hour(et) AS INT) AS fact_trip_end_hour, CAST(minute(et) AS INT) AS fact_trip_end_minute,
        CAST(station AS INT) AS fact_trip_start_station_id, CAST(end_station AS INT) AS fact_trip_end_station_id,
        CAST(bike AS INT) AS fact_trip_bike_id, CAST(kind AS INT) AS fact_trip_user_type_id,
        CAST(year(st) AS INT) AS start_year, CAST(month(st) AS INT) AS start_month
    FROM ({})"""

_EVENT_ROWS = """SELECT *, st + to_seconds(secs) AS et FROM (
        SELECT event_id AS id, ts AS st, CAST(round(value * 60) AS INT) AS secs, {} AS station,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS end_station, user_id AS bike,
            list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS kind
        FROM events)"""

_CALENDAR = """
    SELECT d AS dim_date_id, CAST(year(d) AS INT) AS dim_date_year, CAST(quarter(d) AS INT) AS dim_date_quarter,
        CAST(month(d) AS INT) AS dim_date_month, CAST(day(d) AS INT) AS dim_date_day,
        CAST(week(d) AS INT) AS dim_date_week, CAST(dayofweek(d) + 1 AS INT) AS dim_date_weekday,
        dayofweek(d) IN (0, 6) AS dim_date_is_weekend,
        d IN (SELECT holiday FROM holidays) AS dim_date_is_holiday,
        CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
             WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS dim_date_season
    FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
          FROM ({}))"""

_DEPARTURES = """
    SELECT fact_trip_start_station_id AS station_id, fact_trip_start_date_id AS start_date,
        fact_trip_start_hour AS hour, start_year AS year
    FROM {} WHERE fact_trip_duration BETWEEN 60 AND 86400"""

_PANEL = """
    SELECT s.station_id, d.start_date, CAST(h.hour AS INT) AS hour, coalesce(c.n, 0) AS trip_count
    FROM (SELECT DISTINCT station_id FROM {stations}) s
    CROSS JOIN (SELECT DISTINCT start_date FROM {trips}) d
    CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS hour) h
    LEFT JOIN (SELECT station_id, start_date, hour, count(*) AS n FROM {trips} GROUP BY ALL) c
        ON c.station_id = s.station_id AND c.start_date = d.start_date AND c.hour = h.hour"""

_WITH_CALENDAR = """
    SELECT p.*, dim_date_year AS year, dim_date_quarter AS quarter, dim_date_month AS month,
        dim_date_weekday AS weekday, dim_date_week AS week_of_year,
        CAST(dim_date_is_weekend AS TINYINT) AS is_weekend, CAST(dim_date_is_holiday AS TINYINT) AS is_holiday,
        dim_date_season AS season
    FROM {} p JOIN {} d ON d.dim_date_id = p.start_date"""

_PRIOR = """
    SELECT c.*, h.m AS py_station_hour_weekday_mean, mo.m AS py_station_month_mean
    FROM {src} c
    LEFT JOIN (SELECT station_id, {per} + 1 AS nxt, hour, weekday, avg(trip_count) AS m
               FROM {src} GROUP BY station_id, {per}, hour, weekday) h
      ON h.station_id = c.station_id AND h.nxt = c.{per} AND h.hour = c.hour AND h.weekday = c.weekday
    LEFT JOIN (SELECT station_id, {per} + 1 AS nxt, month, avg(trip_count) AS m
               FROM {src} GROUP BY station_id, {per}, month) mo
      ON mo.station_id = c.station_id AND mo.nxt = c.{per} AND mo.month = c.month"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), """
    SELECT *, st + to_seconds(secs) AS et FROM (
        SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, o_orderdate AS d,
            o_orderpriority AS pr, (l_partkey * 31 + l_linenumber) % 997 AS e,
            CAST(CASE WHEN l_partkey % 401 = 0 THEN 30 WHEN l_partkey % 409 = 1 THEN 90000
                 ELSE l_quantity * 60 + l_partkey % 53 END AS INT) AS secs,
            o_orderdate + to_minutes((l_orderkey * 7 + l_linenumber) % 24 * 60 + l_partkey % 60) AS st
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""),
    "trips": (("lines",), _FACT.format("""
        SELECT k * 8 + n AS id, st, et, secs, s AS station, e AS end_station, p AS bike, pr[1] AS kind FROM lines""")),
    "raw": (("lines",), f"""
    SELECT CASE k % 97 WHEN 1 THEN NULL WHEN 2 THEN 'abc' ELSE CAST(k * 8 + n AS VARCHAR) END AS trip_id,
        CASE p % 89 WHEN 3 THEN '0' WHEN 4 THEN 'abc' WHEN 5 THEN '-5' WHEN 6 THEN NULL
             WHEN 7 THEN secs || '.9' ELSE CAST(secs AS VARCHAR) END AS trip_duration,
        CASE (k + n) % 83 WHEN 1 THEN '13/45/2019 10:00' WHEN 2 THEN strftime(st, '%Y-%m-%d %H:%M')
             WHEN 3 THEN NULL ELSE strftime(st, {_FMT}) END AS start_time,
        CASE k % 79 WHEN 1 THEN NULL WHEN 2 THEN 'X1' ELSE CAST(s AS VARCHAR) END AS start_station_id,
        CASE WHEN s % 37 = 5 OR k % 13 = 0 THEN 'NULL' WHEN k % 13 = 1 THEN ' ' WHEN k % 13 = 2 THEN NULL
             ELSE ' Dock ' || s || ' rev ' || (year(d) - 1994) || ' ' END AS start_station_name,
        CASE (k + n) % 11 WHEN 0 THEN NULL WHEN 1 THEN strftime(et, '%Y-%m-%d %H:%M')
             ELSE strftime(et, {_FMT}) END AS end_time,
        CASE k % 73 WHEN 1 THEN NULL ELSE CAST(e AS VARCHAR) END AS end_station_id,
        CASE WHEN e % 37 = 5 THEN 'NULL' WHEN k % 17 = 0 THEN NULL
             ELSE 'Dock ' || e || ' rev ' || (year(d) - 1994) || CASE WHEN n % 2 = 0 THEN 'b' ELSE '' END
             END AS end_station_name,
        CASE p % 19 WHEN 0 THEN '' WHEN 1 THEN 'X1' WHEN 2 THEN NULL ELSE CAST(p AS VARCHAR) END AS bike_id,
        CASE pr WHEN '1-URGENT' THEN 'Annual Member' WHEN '2-HIGH' THEN 'Casual Member' || chr(13)
             WHEN '3-MEDIUM' THEN ' Annual Member ' WHEN '5-LOW' THEN 'Corporate'
             ELSE CASE WHEN k % 2 = 0 THEN NULL ELSE ' ' END END AS user_type,
        CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE ' Model-' || (p % 26) || ' ' END AS model,
        CAST(year(d) AS VARCHAR) AS source_year
    FROM lines"""),
    "judged": (("raw",), f"""
    SELECT *, coalesce(regexp_matches(trip_id, '^[0-9]+$') AND regexp_matches(trip_duration, '^[0-9]+(\\.[0-9]+)?$')
            AND TRY_CAST(trip_duration AS DOUBLE) > 0 AND regexp_matches(start_station_id, '^[0-9]+$')
            AND regexp_matches(end_station_id, '^[0-9]+$') AND regexp_matches(start_time, {_STAMP})
            AND try_strptime(start_time, {_FMT}) IS NOT NULL, false) AS ok
    FROM raw"""),
    "stage": (("judged",), f"""
    SELECT trip_id, trip_duration, start_time, start_station_id,
        CASE WHEN coalesce(trim(start_station_name), '') IN ('', 'NULL') THEN 'UNKNOWN'
             ELSE trim(start_station_name) END AS start_station_name,
        CASE WHEN regexp_matches(end_time, {_STAMP}) AND try_strptime(end_time, {_FMT}) IS NOT NULL THEN end_time
             ELSE strftime(strptime(start_time, {_FMT}) + to_seconds(CAST(floor(CAST(trip_duration AS DOUBLE)) AS BIGINT)),
                           {_FMT}) END AS end_time,
        end_station_id,
        CASE WHEN coalesce(trim(end_station_name), '') IN ('', 'NULL') THEN 'UNKNOWN'
             ELSE trim(end_station_name) END AS end_station_name,
        CASE WHEN regexp_matches(bike_id, '^[0-9]+$') THEN bike_id ELSE '-1' END AS bike_id,
        CASE trim(replace(coalesce(user_type, ''), chr(13), '')) WHEN 'Annual Member' THEN 'annual'
             WHEN 'Casual Member' THEN 'casual' WHEN '' THEN 'UNKNOWN'
             ELSE trim(replace(user_type, chr(13), '')) END AS user_type,
        CASE WHEN coalesce(trim(model), '') = '' THEN 'UNKNOWN' ELSE trim(model) END AS model,
        source_year
    FROM judged WHERE ok"""),
    "sightings": (("stage",), f"""
    SELECT CAST(start_station_id AS INT) AS station_id, start_station_name AS station_name,
        strptime(start_time, {_FMT}) AS seen_at FROM stage
    UNION ALL
    SELECT CAST(end_station_id AS INT), end_station_name, strptime(end_time, {_FMT}) FROM stage"""),
    "dim_station": (("sightings",), """
    SELECT station_id AS dim_station_id, station_name AS dim_station_name FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id
            ORDER BY (station_name = 'UNKNOWN')::INT, seen_at DESC, station_name DESC) AS rn FROM sightings)
    WHERE rn = 1"""),
    "dim_bike": (("stage",), """
    SELECT CAST(bike_id AS INT) AS dim_bike_id,
        coalesce(max(CASE WHEN model <> 'UNKNOWN' THEN model END), 'UNKNOWN') AS dim_bike_model
    FROM stage GROUP BY 1"""),
    "dim_user_type": (("stage",), """
    SELECT CAST(row_number() OVER (ORDER BY user_type) AS INT) AS dim_user_type_id,
        user_type AS dim_user_type_name
    FROM (SELECT DISTINCT user_type FROM stage)"""),
    "typed": (("stage",), f"""
    SELECT CAST(trip_id AS BIGINT) AS fact_trip_source_id,
        CAST(floor(CAST(trip_duration AS DOUBLE)) AS INT) AS fact_trip_duration,
        st AS fact_trip_start_ts, et AS fact_trip_end_ts,
        CAST(st AS DATE) AS fact_trip_start_date_id, CAST(et AS DATE) AS fact_trip_end_date_id,
        CAST(hour(st) AS INT) AS fact_trip_start_hour, CAST(minute(st) AS INT) AS fact_trip_start_minute,
        CAST(hour(et) AS INT) AS fact_trip_end_hour, CAST(minute(et) AS INT) AS fact_trip_end_minute,
        CAST(start_station_id AS INT) AS fact_trip_start_station_id,
        CAST(end_station_id AS INT) AS fact_trip_end_station_id, CAST(bike_id AS INT) AS fact_trip_bike_id,
        user_type, CAST(year(st) AS INT) AS start_year, CAST(month(st) AS INT) AS start_month
    FROM (SELECT *, strptime(start_time, {_FMT}) AS st, strptime(end_time, {_FMT}) AS et FROM stage)"""),
    "fact": (("typed", "dim_user_type"), """
    SELECT row_number() OVER (ORDER BY fact_trip_source_id) AS fact_trip_id, t.* EXCLUDE (user_type),
        dim_user_type_id AS fact_trip_user_type_id
    FROM typed t JOIN dim_user_type ON user_type = dim_user_type_name"""),
    "holidays": ((), """
    SELECT make_date(y, m, dd) AS holiday
    FROM (SELECT unnest([1994, 1995, 1996, 1997, 1998, 1999, 2000, 2001, 2002, 2024]) AS y),
         (VALUES (1, 1), (7, 1), (12, 25), (12, 26)) f(m, dd)
    UNION ALL
    SELECT CAST(first + CAST((8 - isodow(first)) % 7 + 7 * (nth - 1) AS INT) AS DATE)
    FROM (SELECT make_date(y, m, 1) AS first, nth
          FROM (SELECT unnest([1994, 1995, 1996, 1997, 1998, 1999, 2000, 2001, 2002, 2024]) AS y),
               (VALUES (2, 3), (9, 1), (10, 2)) f(m, nth) WHERE m <> 2 OR y >= 2008)
    UNION ALL
    SELECT CAST(make_date(y, 5, 24) - CAST(isodow(make_date(y, 5, 24)) - 1 AS INT) AS DATE)
    FROM (SELECT unnest([1994, 1995, 1996, 1997, 1998, 1999, 2000, 2001, 2002, 2024]) AS y)
    UNION ALL
    SELECT unnest([DATE '1994-04-01', DATE '1995-04-14', DATE '1996-04-05', DATE '1997-03-28', DATE '1998-04-10',
                   DATE '1999-04-02', DATE '2000-04-21', DATE '2001-04-13', DATE '2002-03-29', DATE '2024-03-29'])
    UNION ALL
    SELECT unnest([DATE '1994-01-03', DATE '1995-01-02', DATE '1999-12-27', DATE '1999-12-28', DATE '2000-01-03'])"""),
    "dim_date": (("stage", "holidays"), _CALENDAR.format(f"""
        SELECT min(CAST(strptime(start_time, {_FMT}) AS DATE)) AS lo,
            max(CAST(strptime(end_time, {_FMT}) AS DATE)) AS hi FROM stage""")),
    "cal": (("trips", "holidays"), _CALENDAR.format(
        "SELECT min(fact_trip_start_date_id) AS lo, max(fact_trip_end_date_id) AS hi FROM trips")),
    "departures": (("trips",), _DEPARTURES.format("trips")),
    "ranked": (("departures",), """
    SELECT *, row_number() OVER (PARTITION BY year ORDER BY trips DESC, station_id) AS rnk
    FROM (SELECT station_id, year, count(*) AS trips FROM departures GROUP BY ALL)"""),
    "pool": (("departures", "ranked"), """
    SELECT l.station_id, s_name AS station_name, first_trip, last_trip,
        count(DISTINCT year) AS top_years, min(rnk) AS best_rank
    FROM (SELECT station_id, min(start_date) AS first_trip, max(start_date) AS last_trip
          FROM departures GROUP BY station_id) l
    JOIN ranked r ON r.station_id = l.station_id AND rnk <= 50
    LEFT JOIN supplier ON s_suppkey = l.station_id
    WHERE first_trip <= DATE '1995-01-31' AND last_trip >= DATE '2001-06-01'
    GROUP BY ALL"""),
    "pooled": (("departures", "pool"), """
    SELECT * FROM departures WHERE station_id IN (SELECT station_id FROM pool)"""),
    "panel": (("pool", "pooled"), _PANEL.format(stations="pool", trips="pooled")),
    "cal_panel": (("panel", "cal"), _WITH_CALENDAR.format("panel", "cal")),
    "featured": (("cal_panel",), _PRIOR.format(src="cal_panel", per="year")),
    "ysplit": (("featured",), """
    SELECT *, CASE WHEN year <= 1998 THEN 'train' WHEN year = 1999 THEN 'val' ELSE 'test' END AS split
    FROM featured"""),
    "ev_trips": ((), _FACT.format(_EVENT_ROWS.format("user_id"))),
    "ev_departures": (("ev_trips",), _DEPARTURES.format("ev_trips")),
    "ev_cal": (("ev_trips", "holidays"), _CALENDAR.format(
        "SELECT min(fact_trip_start_date_id) AS lo, max(fact_trip_end_date_id) AS hi FROM ev_trips")),
    "ev_panel": (("ev_departures",), _PANEL.format(stations="ev_departures", trips="ev_departures")),
    "ev_cal_panel": (("ev_panel", "ev_cal"), _WITH_CALENDAR.format("ev_panel", "ev_cal")),
    "zone_trips": ((), _FACT.format(_EVENT_ROWS.format("user_id // 20"))),
    "zone_departures": (("zone_trips",), _DEPARTURES.format("zone_trips")),
    "zone_panel": (("zone_departures",), _PANEL.format(stations="zone_departures", trips="zone_departures")),
    "zone_cal_panel": (("zone_panel", "ev_cal"), _WITH_CALENDAR.format("zone_panel", "ev_cal")),
    "zone_featured": (("zone_cal_panel",), _PRIOR.format(src="zone_cal_panel", per="week_of_year")),
    "wsplit": (("zone_featured",), """
    SELECT *, CASE WHEN week_of_year <= 2 THEN 'train' WHEN week_of_year = 3 THEN 'val' ELSE 'test' END AS split
    FROM zone_featured"""),
    "cells": (("wsplit",), """
    SELECT station_id, hour, weekday, avg(trip_count) AS baseline, quantile_cont(trip_count, 0.5) AS q50,
        quantile_cont(trip_count, 0.8) AS q80, quantile_cont(trip_count, 0.9) AS q90
    FROM wsplit WHERE split = 'train' GROUP BY ALL"""),
    "preds": (("wsplit", "cells"), """
    SELECT split, w.station_id, start_date, w.hour, is_weekend, CAST(trip_count AS DOUBLE) AS y,
        unnest(['baseline', 'q50', 'q80', 'q90']) AS model, unnest([baseline, q50, q80, q90]) AS p
    FROM wsplit w JOIN cells c ON c.station_id = w.station_id AND c.hour = w.hour AND c.weekday = w.weekday"""),
    "ev_split": (("ev_cal_panel",), """
    SELECT *, CASE WHEN week_of_year <= 2 THEN 'train' WHEN week_of_year = 3 THEN 'val' ELSE 'test' END AS split
    FROM ev_cal_panel"""),
    "requests": ((), """
    SELECT event_id AS request_id, event_id % 12 AS m, CAST(user_id AS INT) AS station_id,
        CAST(hour(ts) AS INT) AS hour, CAST(ts AS DATE) + CAST(CASE WHEN event_id % 2 = 0 THEN 60 ELSE 0 END AS INT) AS day
    FROM events"""),
    "good": (("requests",), """
    SELECT request_id, 0 AS position, station_id, hour, CAST(day AS DATE) AS start_date
    FROM requests WHERE m IN (0, 1, 2, 10)
    UNION ALL
    SELECT request_id, 1, station_id, (hour + 1) % 24, CAST(day AS DATE) FROM requests WHERE m IN (0, 1)"""),
    "tests": (("preds",), "SELECT * FROM preds WHERE split = 'test'"),
}


def with_ctes(body: str, *names: str) -> str:
    """`body` behind a WITH clause that holds `names` and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    clause = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {clause}\n{body}"
