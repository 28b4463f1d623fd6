"""The same queries in SQL over the given tables, for checking.

The SQL states the derivation of ``plans/standin.py`` and each query anew, in the
plainest form: joins, grouping, ``median``, ``unnest``.
"""

from __future__ import annotations

from spanwatch.model import (
    ACCELEROMETERS,
    GAUGES,
    HUB_SENSORS,
    HUBS,
    LOCATIONS,
    TABLE_KEYS,
    THERMOMETERS,
    accel_columns,
    hub_of,
    sst_columns,
    table_schema,
    thermometer_of,
)
from spanwatch.plans.queries import GIVEN


def _reading(sensor: str) -> str:
    i = int(sensor[1:])
    if sensor in GAUGES:
        return f"CAST(CASE WHEN event_type <> 'error' THEN value * {i} + k END AS FLOAT)"
    value = f"CAST(k AS DOUBLE) / 2 - {i}"
    if i % 2 == 0:
        value = f"CASE WHEN event_type <> 'purchase' THEN {value} END"
    return f"CAST({value} AS FLOAT)"


def _axis(column: str) -> str:
    sensor, axis = column.split("_")
    i = int(sensor[1:])
    value = {
        "t": "k",
        "x": f"value / {100 + i}",
        "y": "CAST(k AS DOUBLE) / 50",
        "z": str((i - 29) / 4),
    }[axis]
    if sensor == "A32":
        value = f"CASE WHEN event_type <> 'click' THEN {value} END"
    return f"CAST({value} AS FLOAT)"


def _sst(hub: str, where: str = "true") -> str:
    columns = ", ".join(f"{_reading(c)} AS {c}" for c in sst_columns(hub))
    return f"SELECT ts AS datetime, {columns} FROM e WHERE {where}"


_EVENTS = "e AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)"
_ACCEL = (
    "accel_all AS (SELECT ts AS datetime, "
    + ", ".join(f"{_axis(c)} AS {c}" for c in accel_columns())
    + " FROM e)"
)
_NAMES = "[" + ", ".join(f"'{a}'" for a in ACCELEROMETERS) + "]"
_SPECTRA = f"""spectra AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(vec_id AS INTEGER)) AS datetime,
         {_NAMES}[label % 6 + 1] AS sensor_id,
         CAST(label + 0.5 AS FLOAT) AS fft_main_f, embedding[1] AS fft_main_a,
         list_transform(range(len(embedding)), lambda i: CAST(i * 0.5 AS FLOAT)) AS fft_freqs,
         embedding AS fft_amps
  FROM embeddings)"""


def _ids(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


_PRESENT = {"hub3": "event_type <> 'view'"}
_VIEWS = {"accel_all": _ACCEL}
for _hub in HUBS:
    _VIEWS[f"fft_{_hub}"] = (
        f"fft_{_hub} AS (SELECT * FROM spectra WHERE sensor_id IN ({_ids(HUB_SENSORS[_hub]['A'])}))"
    )
    _VIEWS[f"sst_{_hub}"] = (
        f"sst_{_hub} AS ({_sst(_hub, _PRESENT.get(_hub, 'true'))})"
    )


def _with(*names: str) -> str:
    """WITH clause of the stand-in tables a query needs."""
    parts = [_EVENTS]
    if any(n.startswith("fft_") or n == "spectra" for n in names):
        parts.append(_SPECTRA)
    parts += [_VIEWS[n] for n in names if n != "spectra"]
    return "WITH " + ",\n".join(parts) + "\n"


def _week(t: str) -> str:
    return f"CAST(isoyear({t}) AS INTEGER) AS iso_year, CAST(week({t}) AS INTEGER) AS iso_week"


def _label(t: str) -> str:
    return f"printf('%dW%02d', isoyear({t}), week({t}))"


def _bin(minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', datetime, TIMESTAMP '1970-01-01')"


def _union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _means(columns, minutes: int, where: str, source: str) -> str:
    avgs = ", ".join(f"round(avg({c}), 6) AS {c}" for c in columns)
    return (
        f"SELECT {_bin(minutes)} AS bin_start, {minutes} AS bin_minutes, {avgs} "
        f"FROM {source} WHERE {where} GROUP BY 1 ORDER BY 1"
    )


def _last7(source: str) -> str:
    return (
        f"datetime BETWEEN (SELECT max(datetime) - INTERVAL 7 DAY FROM {source}) "
        f"AND (SELECT max(datetime) FROM {source})"
    )


_ARCH = "(SELECT datetime, T1, NULL AS T2, NULL AS T3 FROM sst_hub2 UNION ALL SELECT datetime, NULL, T2, NULL FROM sst_hub3 UNION ALL SELECT datetime, NULL, NULL, T3 FROM sst_hub4)"


def _strain_temp(minutes: int, last7: bool = True) -> str:
    parts = []
    for g in GAUGES:
        t, hub = thermometer_of(g), f"sst_{hub_of(g)}"
        where = f"WHERE {_last7(hub)}" if last7 else ""
        parts.append(
            f"SELECT '{g}' AS sensor_id, '{LOCATIONS[g]}' AS label, '{t}' AS temp_sensor_id, "
            f"{_bin(minutes)} AS bin_start, {minutes} AS bin_minutes, "
            f"CAST(median({g}) AS FLOAT) AS strain_raw, "
            f"CAST(CAST(median({g}) AS FLOAT) AS DOUBLE) * CAST(3.11e-9 AS DOUBLE) * 1000 AS epsilon_mm, "
            f"CAST(median({t}) AS FLOAT) AS temp FROM {hub} {where} GROUP BY bin_start"
        )
    return _union_all(parts)


def _length(a: str) -> str:
    return f"sqrt({a}_x*{a}_x + {a}_y*{a}_y + {a}_z*{a}_z)"


def _minutes(where: str = "true", digits: bool = True) -> str:
    avg = "round(avg({0}), 6)" if digits else "avg({0})"
    return _union_all(
        f"SELECT '{a}' AS sensor_id, date_trunc('minute', datetime) AS minute, "
        f"{avg.format(_length(a))} AS v_avg, min({_length(a)}) AS v_min, max({_length(a)}) AS v_max "
        f"FROM accel_all WHERE {where} GROUP BY 2"
        for a in ACCELEROMETERS
    )


_GRID_DAYS = """lim AS (SELECT greatest(CAST(max(datetime) - INTERVAL 7 DAY AS DATE), CAST(max(datetime) AS DATE) - 6) AS first,
         CAST(max(datetime) AS DATE) AS last FROM accel_all)"""


def _grid() -> str:
    where = (
        "datetime >= (SELECT first FROM lim) "
        "AND datetime < (SELECT CAST(last AS TIMESTAMP) + INTERVAL 1 DAY FROM lim)"
    )
    return f"""{_with("accel_all").rstrip()}, {_GRID_DAYS},
m AS ({_minutes(where, digits=False)}),
spine AS (SELECT CAST(d AS DATE) AS day, sensor_id FROM lim,
          unnest(range(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS r(d),
          unnest([{_ids(ACCELEROMETERS)}]) AS s(sensor_id)),
grid AS (SELECT spine.sensor_id, spine.day, strftime(spine.day, '%d. %b.') AS day_label,
         (hour(minute) * 3600 + minute(minute) * 60) / CAST(3600 AS DOUBLE) AS hour, v_avg, v_min, v_max
         FROM spine LEFT JOIN m ON m.sensor_id = spine.sensor_id AND CAST(m.minute AS DATE) = spine.day)
"""


def _fft_all() -> str:
    return _union_all(f"SELECT '{h}' AS hub, * FROM fft_{h}" for h in HUBS)


_FFT = [f"fft_{h}" for h in HUBS]
_SSTS = [f"sst_{h}" for h in HUBS]

_POINTS = """u AS (SELECT sensor_id, datetime, unnest(fft_freqs) AS freq, unnest(fft_amps) AS amp FROM {source}),
points AS (SELECT * FROM u WHERE amp >= CAST(0.08 AS FLOAT))"""


def _kde(keys: list[str], source: str) -> str:
    k = ", ".join(keys)
    unnested = f"SELECT {k}, unnest(fft_freqs) AS freq, unnest(fft_amps) AS amp FROM {source}"
    return f"""u AS ({unnested}),
points AS (SELECT * FROM u WHERE amp >= CAST(0.08 AS FLOAT)),
w AS (SELECT {k}, CAST(freq AS DOUBLE) AS f, count(*) AS n FROM points GROUP BY ALL),
st AS (SELECT {k}, count(*) AS total, min(CAST(freq AS DOUBLE)) AS low, max(CAST(freq AS DOUBLE)) AS high,
       sqrt(var_samp(CAST(freq AS DOUBLE))) * pow(count(*), -0.2) AS h,
       min(amp) AS amp_min, max(amp) AS amp_max, count(*) AS n_points FROM points GROUP BY ALL),
kg AS (SELECT st.*, CAST(g AS INTEGER) AS k,
       CASE WHEN g = 499 THEN high ELSE low + g * ((high - low) / 499) END AS x
       FROM st, range(500) AS r(g) WHERE total >= 2 AND low < high),
kde AS (SELECT {", ".join(f"kg.{c}" for c in keys)}, k, x, amp_min, amp_max, n_points,
        sum(n * exp(-0.5 * ((x - f) / h) * ((x - f) / h))) / (total * h * sqrt(2 * pi())) AS density
        FROM kg JOIN w ON {" AND ".join(f"kg.{c} = w.{c}" for c in keys)}
        GROUP BY {", ".join(f"kg.{c}" for c in keys)}, k, x, total, h, amp_min, amp_max, n_points),
peaks AS (SELECT {k}, arg_max(x, {{'d': density, 'k': -k}}) AS f_peak, max(density) AS density,
          any_value(n_points) AS n_points, any_value(amp_min) AS amp_min, any_value(amp_max) AS amp_max
          FROM kde GROUP BY ALL)
"""


def _versions(hub: str = "hub2") -> str:
    return (
        f"WITH {_EVENTS}, old AS ({_sst(hub, "event_type <> 'signup'")}), "
        f"new AS ({_sst(hub, "event_type <> 'view'")})\n"
    )


# Kinds of events whose chunks lack a column.
_EARLY = "event_type IN ('error', 'click')"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
_LINE = f"""'{{"time":{{"datetime":"' || {_ISO} || '"}},"S7":{{"s":' || event_id || '}}}}'"""
_SLICE = f"{_label('ts')} || '_' || isodow(ts)"


def _columns_of(key: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in table_schema(key).fields]


def _describe() -> str:
    parts = []
    for key in TABLE_KEYS:
        for i, (name, kind) in enumerate(_columns_of(key), start=1):
            parts.append(
                f"SELECT '{key}' AS table_key, {i} AS position, '{name}' AS column_name, "
                f"'{kind}' AS column_type, (SELECT count(*) FROM {key}) AS n_rows"
            )
    return _with(*TABLE_KEYS) + _union_all(parts)


def _spine(sources: str) -> str:
    return f"""SELECT {_week('d')}, {_label('d')} AS week, CAST(d AS DATE) AS monday,
       CAST(d AS DATE) + 6 AS sunday, CAST(d AS DATE) + 7 AS next_monday
FROM (SELECT unnest(range(CAST(date_trunc('week', min(t)) AS TIMESTAMP),
             CAST(max(t) AS TIMESTAMP) + INTERVAL 1 MICROSECOND, INTERVAL 7 DAY)) AS d FROM ({sources}))"""


_ALL_TIMES = " UNION ALL ".join(f"SELECT datetime AS t FROM {key}" for key in TABLE_KEYS)


def _rows_per_week() -> str:
    counted = _union_all(
        f"SELECT '{key}' AS table_key, isoyear(datetime) AS y, week(datetime) AS w, count(*) AS n "
        f"FROM {key} GROUP BY ALL"
        for key in TABLE_KEYS
    )
    return f"""{_with(*TABLE_KEYS).rstrip()}, spine AS ({_spine(_ALL_TIMES)}), counted AS ({counted})
SELECT t.table_key, spine.iso_year, spine.iso_week, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
FROM spine CROSS JOIN unnest([{_ids(TABLE_KEYS)}]) AS t(table_key)
LEFT JOIN counted ON counted.table_key = t.table_key AND y = iso_year AND w = iso_week"""


def _coverage() -> str:
    observed, expected = [], []
    monday = "CAST(date_trunc('week', datetime) AS DATE)"
    for a in ACCELEROMETERS:
        hub = hub_of(a)
        for kind in ("acceleration", "spectrum"):
            expected.append(f"('{kind}', '{a}', '{LOCATIONS[a]}')")
        observed.append(
            f"SELECT 'acceleration' AS series, '{a}' AS sensor_id, {monday} AS monday FROM accel_all "
            f"WHERE {a}_x IS NOT NULL OR {a}_y IS NOT NULL OR {a}_z IS NOT NULL"
        )
        observed.append(f"SELECT 'spectrum', sensor_id, {monday} FROM fft_{hub} WHERE sensor_id = '{a}'")
    for s in GAUGES + THERMOMETERS:
        kind = "strain" if s in GAUGES else "temperature"
        expected.append(f"('{kind}', '{s}', '{LOCATIONS[s]}')")
        observed.append(f"SELECT '{kind}', '{s}', {monday} FROM sst_{hub_of(s)} WHERE {s} IS NOT NULL")
    return f"""{_with(*TABLE_KEYS).rstrip()}, spine AS ({_spine(_ALL_TIMES)}),
observed AS ({_union_all(observed)}),
expected AS (SELECT * FROM (VALUES {", ".join(expected)}) AS v(series, sensor_id, label))
SELECT x.series, x.sensor_id, x.label, spine.monday, spine.week FROM expected x CROSS JOIN spine
WHERE NOT EXISTS (SELECT 1 FROM observed o WHERE o.series = x.series AND o.sensor_id = x.sensor_id
                  AND o.monday = spine.monday)"""


def _backfill() -> str:
    parts = []
    hour = _bin(60)
    for t in THERMOMETERS:
        chart = "temps_col" if hub_of(t) == "hub1" else "temps_arch"
        parts.append(
            f"SELECT '{chart}' AS chart, '{t}' AS sensor_id, {hour} AS bucket, avg({t}) AS low, avg({t}) AS high "
            f"FROM sst_{hub_of(t)} GROUP BY bucket"
        )
    for g in GAUGES:
        eps = f"CAST(CAST(median({g}) AS FLOAT) AS DOUBLE) * CAST(3.11e-9 AS DOUBLE) * 1000"
        parts.append(
            f"SELECT 'strain_temp', '{g}', {hour} AS bucket, {eps}, {eps} FROM sst_{hub_of(g)} GROUP BY bucket"
        )
    for a in ACCELEROMETERS:
        parts.append(
            f"SELECT 'daily_v_grid', '{a}', date_trunc('minute', datetime) AS bucket, min({_length(a)}), "
            f"max({_length(a)}) FROM accel_all GROUP BY bucket"
        )
    source = f"(SELECT *, {_week('datetime')} FROM ({_fft_all()}))"
    return f"""{_with(*TABLE_KEYS).rstrip()}, series AS ({_union_all(parts)}),
{_kde(["iso_year", "iso_week", "sensor_id"], source).rstrip()}
SELECT {_week('bucket')}, chart, sensor_id, count(low) AS n_points, round(min(low), 6) AS value_min,
       round(max(high), 6) AS value_max, CAST(NULL AS DOUBLE) AS f_peak
FROM series GROUP BY ALL HAVING count(low) > 0
UNION ALL
SELECT iso_year, iso_week, 'fft_kde', sensor_id, n_points, round(CAST(amp_min AS DOUBLE), 6),
       round(CAST(amp_max AS DOUBLE), 6), round(f_peak, 6) FROM peaks"""


def _diff_sides() -> str:
    columns = sst_columns("hub2")
    new = ", ".join(f"new.{c} AS new_{c}" for c in columns)
    old = ", ".join(f"old.{c} AS old_{c}" for c in columns)
    return (
        f"SELECT new.datetime AS new_dt, old.datetime AS old_dt, datetime, {new}, {old} "
        "FROM new FULL OUTER JOIN old USING (datetime) "
        "WHERE old.datetime IS NULL OR new.datetime IS NULL "
        "ORDER BY new_dt NULLS LAST, old_dt NULLS LAST"
    )


def _diff_except() -> str:
    columns = ", ".join(["datetime", *sst_columns("hub2")])
    side = "SELECT '{0}' AS side, {1}, count(*) AS copies FROM (SELECT * FROM {0} EXCEPT ALL SELECT * FROM {2}) GROUP BY ALL"
    return side.format("new", columns, "old") + " UNION ALL " + side.format("old", columns, "new")


def _compare() -> str:
    both = [k for k in TABLE_KEYS if k not in ("fft_hub1", "fft_hub4", "sst_hub1", "sst_hub2")]
    row = (
        "SELECT '{0}' AS file, '{1}' AS status, CAST({2} AS BIGINT) AS rows_old, "
        "CAST({3} AS BIGINT) AS rows_new, {4} AS schema_match"
    )
    n = "(SELECT count(*) FROM {})".format
    parts = [row.format(k, "OK", n(k), n(k), "true") for k in both]
    parts.append(row.format("fft_hub1", "missing in NEW", n("fft_hub1"), "NULL", "false"))
    parts.append(row.format("fft_hub4", "missing in OLD", "NULL", n("fft_hub4"), "false"))
    parts.append(row.format("sst_hub1", "DIFF", n("sst_hub1"), n("sst_hub1"), "false"))
    old = "(SELECT count(*) FROM e WHERE event_type <> 'signup')"
    new = "(SELECT count(*) FROM e WHERE event_type <> 'view')"
    parts.append(
        f"SELECT 'sst_hub2', CASE WHEN {old} = {new} THEN 'OK' ELSE 'DIFF' END, {old}, {new}, true"
    )
    return _with(*[k for k in TABLE_KEYS if k != "sst_hub2"]) + _union_all(parts)


def _schema_diff() -> str:
    columns = _columns_of("sst_hub2")
    parts = []
    for i, (name, kind) in enumerate(columns, start=1):
        last = i == len(columns)
        other = "double" if name == "S8" else kind
        new = "NULL, NULL" if last else f"'{name}', '{other}'"
        parts.append(f"({i}, '{name}', '{kind}', {new}, {str(not last and other == kind).lower()})")
    return f"""SELECT v.*, (SELECT count(*) FROM events WHERE event_type <> 'signup') AS rows_old,
       (SELECT count(*) FROM events WHERE event_type <> 'view') AS rows_new
FROM (VALUES {", ".join(parts)}) AS v(position, old_name, old_type, new_name, new_type, matches)"""


def _registry_join() -> str:
    def row(s: str, hub: str, kind: str, label: str, value: str, source: str) -> str:
        paired = f"'{thermometer_of(s)}'" if s in GAUGES else "CAST(NULL AS VARCHAR)"
        return (
            f"SELECT '{s}' AS sensor_id, {kind} AS kind, {hub} AS hub, {paired} AS temp_sensor_id, "
            f"'{label}' AS label, count({value}) AS n_values, min({value}) AS value_min, "
            f"max({value}) AS value_max FROM {source} HAVING count(*) > 0"
        )

    parts = [row(s, f"'{hub_of(s)}'", f"'{s[0]}'", LOCATIONS[s], s, f"sst_{hub_of(s)}") for s in GAUGES + THERMOMETERS]
    parts += [
        row(a, f"'{hub_of(a)}'", "'A'", LOCATIONS[a], "fft_main_a", f"(SELECT * FROM spectra WHERE sensor_id = '{a}')")
        for a in ACCELEROMETERS
    ]
    parts.append(row("X99", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "X99", "A30_t", "accel_all"))
    return _with(*_SSTS, "spectra", "accel_all") + _union_all(parts)


def _stored() -> str:
    """Both kinds of documents give a row of the acceleration table."""
    parts = []
    for key in TABLE_KEYS:
        column = {"a": "A30_t", "f": "fft_main_a", "s": _columns_of(key)[1][0]}[key[0]]
        rows = f"SELECT datetime, {column} AS v FROM {key}"
        if key == "accel_all":
            rows += " UNION ALL SELECT datetime, NULL FROM spectra"
        parts.append(
            f"SELECT '{key}' AS table_key, count(*) AS n_rows, min(datetime) AS first_dt, max(datetime) AS last_dt, "
            f"round(sum(CAST(v AS DOUBLE)), 3) AS total FROM ({rows})"
        )
    return _with(*TABLE_KEYS, "spectra") + _union_all(parts)


def _compare_weeks() -> str:
    first, last = "datetime >= TIMESTAMP '2024-01-08'", "datetime < TIMESTAMP '2024-01-22'"
    sides = {
        "o": [("sst_hub1", f"(SELECT * FROM sst_hub1 WHERE {last})"), ("sst_hub2", "old")],
        "n": [("sst_hub1", f"(SELECT * FROM sst_hub1 WHERE {first})"), ("sst_hub2", "new")],
    }
    counted = [
        f"{side} AS ({_union_all(f"SELECT {_week('datetime')}, '{name}' AS file, count(*) AS n FROM {source} GROUP BY ALL" for name, source in tables)})"
        for side, tables in sides.items()
    ]
    return f"""{_versions().rstrip()}, sst_hub1 AS ({_sst('hub1')}), {", ".join(counted)}
SELECT iso_year, iso_week, file, CASE WHEN n.n IS NULL THEN 'missing in NEW' WHEN o.n IS NULL THEN 'missing in OLD'
  WHEN o.n = n.n THEN 'OK' ELSE 'DIFF' END AS status, o.n AS rows_old, n.n AS rows_new,
  o.n IS NOT NULL AND n.n IS NOT NULL AS schema_match
FROM o FULL OUTER JOIN n USING (iso_year, iso_week, file)"""


def _flatten_sst() -> str:
    every = [c for h in HUBS for c in sst_columns(h)]
    parts = []
    for hub in HUBS:
        columns = ", ".join(
            c if c in sst_columns(hub) else f"CAST(NULL AS FLOAT) AS {c}" for c in every
        )
        parts.append(f"SELECT datetime, {columns}, '{hub}' AS hub FROM sst_{hub}")
    return _with(*_SSTS) + _union_all(parts)


def _union_by_name() -> str:
    return _with(*_SSTS) + " UNION ALL BY NAME ".join(f"SELECT * FROM sst_{h}" for h in HUBS)


def _present(a: str) -> str:
    return f"({a}_x IS NOT NULL OR {a}_y IS NOT NULL OR {a}_z IS NOT NULL)"


def _statistics() -> str:
    """One table has lost a week."""
    row = (
        "SELECT '{0}' AS table_key, {1}, {2} AS sensor_id, count(*) AS n_rows, min(datetime) AS first_dt, "
        "max(datetime) AS last_dt FROM {3} WHERE {4} GROUP BY ALL"
    )
    parts = []
    for key in TABLE_KEYS:
        source = key
        if key == "sst_hub1":
            source = "(SELECT * FROM sst_hub1 WHERE NOT (isoyear(datetime) = 2024 AND week(datetime) = 2))"
        week = _week("datetime")
        parts.append(row.format(key, week, "CAST(NULL AS VARCHAR)", source, "true"))
        if key.startswith("fft_"):
            parts.append(row.format(key, week, "sensor_id", source, "true"))
        elif key == "accel_all":
            parts += [row.format(key, week, f"'{a}'", source, _present(a)) for a in ACCELEROMETERS]
        else:
            parts += [row.format(key, week, f"'{c}'", source, f"{c} IS NOT NULL") for c in sst_columns(key[4:])]
    return _with(*TABLE_KEYS) + _union_all(parts)


# Events of the kind that comes after all others, and whether their minute was closed.
_CLOSED = (
    "(SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 1 HOUR "
    ">= date_trunc('minute', {0}) + INTERVAL 1 MINUTE"
)


def _stream_minutes() -> str:
    kept = f"accel_all AS (SELECT * FROM ({_ACCEL[len('accel_all AS ('):-1]} WHERE event_type <> 'error' OR NOT ({_CLOSED.format('ts')})))"
    return f"WITH {_EVENTS}, {kept}\n" + _minutes()


def _late() -> str:
    columns = ", ".join(f"{_axis(c)} AS {c}" for c in accel_columns())
    return f"WITH {_EVENTS} SELECT ts AS datetime, {columns} FROM e WHERE event_type = 'error' AND {_CLOSED.format('ts')}"


def _week_contents() -> str:
    changed = _sst("hub1").replace("FROM e", "FROM (SELECT * REPLACE (CASE WHEN event_id = 7 THEN k + 1 ELSE k END AS k) FROM e)")
    sides = {"sst_hub1": ("a", "b"), "sst_hub2": ("old", "new")}
    parts = []
    for name, (one, two) in sides.items():
        week = "isoyear(datetime) = y AND week(datetime) = w"
        rest = f"EXISTS (SELECT 1 FROM (SELECT * FROM {{0}} WHERE {week} EXCEPT ALL SELECT * FROM {{1}} WHERE {week}))"
        parts.append(f"""SELECT CAST(y AS INTEGER) AS iso_year, CAST(w AS INTEGER) AS iso_week, '{name}' AS file, o.n AS rows_old, n.n AS rows_new,
  {rest.format(one, two)} OR {rest.format(two, one)} AS differ
FROM (SELECT isoyear(datetime) AS y, week(datetime) AS w, count(*) AS n FROM {one} GROUP BY ALL) o
FULL OUTER JOIN (SELECT isoyear(datetime) AS y, week(datetime) AS w, count(*) AS n FROM {two} GROUP BY ALL) n USING (y, w)""")
    return f"""{_versions().rstrip()}, a AS ({_sst('hub1')}), b AS ({changed}), w AS ({_union_all(parts)})
SELECT iso_year, iso_week, file, CASE WHEN rows_new IS NULL THEN 'missing in NEW' WHEN rows_old IS NULL THEN 'missing in OLD'
  WHEN differ THEN 'DIFF' ELSE 'OK' END AS status, rows_old, rows_new, rows_old IS NOT NULL AND rows_new IS NOT NULL AS schema_match FROM w"""


def _hours() -> str:
    columns = ", ".join(["datetime", *sst_columns("hub2")])
    counts = "SELECT date_trunc('hour', datetime) AS hour, count(*) AS n FROM {} GROUP BY ALL"
    rest = "SELECT date_trunc('hour', datetime) AS hour FROM (SELECT {0} FROM {1} EXCEPT ALL SELECT {0} FROM {2})"
    return f"""{_versions().rstrip()}, o AS ({counts.format('old')}), n AS ({counts.format('new')}),
differ AS ({rest.format(columns, 'old', 'new')} UNION {rest.format(columns, 'new', 'old')})
SELECT hour, coalesce(o.n, 0) AS rows_old, coalesce(n.n, 0) AS rows_new FROM differ LEFT JOIN o USING (hour) LEFT JOIN n USING (hour)"""


def _gaps() -> str:
    """Present hours of each series in order; a gap lies between two that do not touch."""
    present, expected = [], []
    hour = "date_trunc('hour', datetime)"
    for a in ACCELEROMETERS:
        expected += [f"('acceleration', '{a}')", f"('spectrum', '{a}')"]
        present.append(f"SELECT DISTINCT 'acceleration' AS series, '{a}' AS sensor_id, {hour} AS h FROM accel_all WHERE {_present(a)}")
        present.append(f"SELECT DISTINCT 'spectrum', sensor_id, {hour} FROM fft_{hub_of(a)} WHERE sensor_id = '{a}'")
    for s in GAUGES + THERMOMETERS:
        kind = "strain" if s in GAUGES else "temperature"
        expected.append(f"('{kind}', '{s}')")
        present.append(f"SELECT DISTINCT '{kind}', '{s}', {hour} FROM sst_{hub_of(s)} WHERE {s} IS NOT NULL")
    return f"""{_with(*TABLE_KEYS).rstrip()}, present AS ({_union_all(present)}),
lim AS (SELECT date_trunc('hour', min(t)) AS low, date_trunc('hour', max(t)) + INTERVAL 1 HOUR AS high FROM ({_ALL_TIMES})),
marks AS (SELECT series, sensor_id, h AS gap_end, h + INTERVAL 1 HOUR AS next FROM present
          UNION ALL SELECT v.series, v.sensor_id, high, NULL FROM (VALUES {", ".join(expected)}) AS v(series, sensor_id), lim),
steps AS (SELECT series, sensor_id, coalesce(lag(next) OVER (PARTITION BY series, sensor_id ORDER BY gap_end), low) AS gap_start, gap_end FROM marks, lim)
SELECT series, sensor_id, gap_start, gap_end, CAST(date_diff('hour', gap_start, gap_end) AS BIGINT) AS n_bins FROM steps WHERE gap_start < gap_end"""


def _sketched() -> str:
    return _with("sst_hub1") + _union_all(
        f"SELECT '{c}' AS sensor_id, {_bin(1440)} AS bin_start, count({c}) AS n, true AS within_error FROM sst_hub1 "
        f"GROUP BY 2 HAVING count({c}) > 0"
        for c in sst_columns("hub1")
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["ingest_range_scan"] = f"""SELECT {_ISO} AS stamp, {_LINE} AS value FROM events
WHERE {_ISO} >= '2024-01-08T00:00:00' AND {_ISO} < '2024-01-15T00:00:00'"""
    sql["export_day_jsonl"] = f"SELECT {_SLICE} AS slice, {_LINE} AS value FROM events"
    sql["export_json_lines"] = f"""WITH {_EVENTS} SELECT '{{"event_id":' || event_id || ',"at":"' ||
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || printf('%03d', CAST(millisecond(ts) % 1000 AS INTEGER)) || '"' ||
  CASE WHEN event_type = 'error' THEN '' ELSE ',"quarter":' || CAST(CAST(k / 4.0 AS FLOAT) AS VARCHAR) END || '}}' AS value FROM e"""
    sql["fetch_one_day"] = f"SELECT {_LINE} AS value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09'"
    sql["export_day_counts"] = (
        f"SELECT {_SLICE} AS slice, CAST(ts AS DATE) AS day, count(*) AS n_documents "
        "FROM events GROUP BY ALL"
    )
    sql["sample_document"] = f"SELECT {_LINE} AS value FROM events ORDER BY value LIMIT 1"
    sql["weekly_write"] = _with("sst_hub1") + f"SELECT *, {_week('datetime')} FROM sst_hub1"
    sql["weekly_merge"] = (
        _with("sst_hub2")
        + f"SELECT * REPLACE (CAST(NULL AS FLOAT) AS S14), {_week('datetime')} "
        + f"FROM ({_sst('hub2', _EARLY)}) UNION ALL SELECT *, {_week('datetime')} "
        + f"FROM ({_sst('hub2', f'NOT ({_EARLY})')})"
    )
    sql["weekly_merge_empty"] = _rows_per_week()
    sql["union_append"] = _versions() + "SELECT * FROM old UNION ALL SELECT * FROM new"
    sql["union_by_name"] = _union_by_name()
    sql["file_inventory"] = _union_all(
        f"SELECT '{t}.parquet' AS file, count(*) AS n_rows FROM {t}" for t in GIVEN
    )
    sql["register_views"] = _with(*TABLE_KEYS) + _union_all(
        f"SELECT '{t}' AS table_key, count(*) AS n_rows, min(datetime) AS first_dt, "
        f"max(datetime) AS last_dt FROM {t}"
        for t in TABLE_KEYS
    )
    sql["describe_tables"] = _describe()

    sql["flatten_accel"] = _with("accel_all") + "SELECT * FROM accel_all"
    sql["flatten_sst"] = _flatten_sst()
    fft = _with(*_FFT).rstrip() + f", fft AS ({_fft_all()})\n"
    sql["flatten_fft"] = (
        fft + "SELECT datetime, hub, sensor_id, fft_main_f, fft_main_a, "
        "CAST(len(fft_freqs) AS INTEGER) AS n_freqs, CAST(len(fft_amps) AS INTEGER) AS n_amps FROM fft"
    )
    sql["flatten_fft_arrays"] = (
        _with("spectra") + "SELECT datetime, sensor_id, CAST(generate_subscripts(fft_amps, 1) - 1 AS INTEGER) AS at, "
        "unnest(fft_freqs) AS freq, unnest(fft_amps) AS amp FROM spectra"
    )
    sql["safe_float"] = f"""WITH {_EVENTS} SELECT event_id, CAST(CASE event_type
  WHEN 'error' THEN value WHEN 'signup' THEN k + 0.5 WHEN 'click' THEN 1
  WHEN 'view' THEN NULL ELSE 1000 + k END AS FLOAT) AS reading FROM e"""
    sql["parse_timestamp"] = f"""SELECT event_id, CASE event_type
  WHEN 'error' THEN {_ISO} || '+02:00' WHEN 'signup' THEN replace({_ISO}, 'T', ' ') || 'Z'
  WHEN 'click' THEN left({_ISO}, 10) WHEN 'view' THEN left({_ISO}, 16) || '-05:30'
  ELSE 'at ' || {_ISO} END AS text,
  CASE event_type WHEN 'error' THEN ts - INTERVAL 2 HOUR WHEN 'signup' THEN ts
  WHEN 'click' THEN date_trunc('day', ts)
  WHEN 'view' THEN date_trunc('minute', ts) + INTERVAL 330 MINUTE END AS datetime FROM events"""
    cut = _LINE.removesuffix(" || '}}'")
    sql["ingest_quarantine"] = f"""SELECT 'not JSON' AS reason, CAST(NULL AS VARCHAR) AS stamp, {cut} AS line
FROM events WHERE event_type = 'error'
UNION ALL SELECT 'unreadable datetime', 'event ' || event_id, NULL FROM events WHERE event_type = 'click'"""
    sql["ingest_week_quarantine"] = f"""SELECT 'not JSON' AS kind, {cut} AS detail FROM events WHERE event_type = 'error'
UNION ALL SELECT 'row', CAST(CAST(event_id AS INTEGER) AS VARCHAR) || '.0' FROM events WHERE event_type NOT IN ('error', 'click', 'signup', 'view')
  AND ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'"""
    sql["ingest_roundtrip"] = sql["stream_ingest"] = _stored()
    sql["stream_bins"] = (
        _with("sst_hub1")
        + f"SELECT {_bin(60)} AS bin_start, 60 AS bin_minutes, round(avg(T4), 6) AS T4, round(avg(T5), 6) AS T5, "
        "round(avg(T6), 6) AS T6 FROM sst_hub1 GROUP BY 1"
    )

    sql["range_filter"] = (
        _with("sst_hub1") + "SELECT * FROM sst_hub1 WHERE datetime BETWEEN "
        "TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"
    )
    sql["last_7_days"] = _with("sst_hub1") + f"SELECT * FROM sst_hub1 WHERE {_last7('sst_hub1')}"
    three = ["sst_hub2", "sst_hub3", "sst_hub4"]
    sql["last_7_days_multi"] = (
        _with(*three).rstrip()
        + ", a AS ("
        + _union_all(f"SELECT '{t[4:]}' AS hub, datetime FROM {t}" for t in three)
        + f") SELECT * FROM a WHERE {_last7('a')}"
    )
    sql["time_bounds"] = _with(*TABLE_KEYS) + _union_all(
        f"SELECT '{t}' AS table_key, min(datetime) AS start_dt, max(datetime) AS end_dt FROM {t}"
        for t in TABLE_KEYS
    )
    least = ", ".join(f"(SELECT min(datetime) FROM {t})" for t in TABLE_KEYS)
    sql["time_bounds_multi"] = (
        _with(*TABLE_KEYS)
        + f"SELECT least({least}) AS start_dt, greatest({least.replace('min(', 'max(')}) AS end_dt"
    )
    monday = "CAST(date_trunc('week', o_orderdate) AS DATE)"
    sql["iso_week"] = f"""SELECT {_week('o_orderdate')}, {_label('o_orderdate')} AS week, {monday} AS monday,
  {monday} + 6 AS sunday, {monday} + 7 AS next_monday, count(*) AS n_orders FROM orders GROUP BY ALL"""
    sql["week_label"] = (
        f"SELECT {_label('o_orderdate')} AS week, count(*) AS n_orders FROM orders GROUP BY ALL"
    )
    sql["week_spine"] = _spine("SELECT o_orderdate AS t FROM orders UNION ALL SELECT ts FROM events")

    col = ["T4", "T5", "T6"]
    arch = ["T1", "T2", "T3"]
    sql["temps_col"] = _with("sst_hub1") + _means(col, 60, _last7("sst_hub1"), "sst_hub1")
    sql["temps_col_bins"] = _with("sst_hub1") + _means(col, 15, "true", "sst_hub1")
    stacked = _with(*three).rstrip() + f", arch AS {_ARCH}\n"
    sql["temps_arch"] = stacked + _means(arch, 60, _last7("arch"), "arch")
    sql["temps_arch_bins"] = stacked + _means(arch, 20, "true", "arch")
    sql["strain_temp"] = _with(*_SSTS) + _strain_temp(60)
    sql["strain_temp_bins"] = _with(*_SSTS) + _strain_temp(20)
    sql["registry_join"] = _registry_join()
    sql["accel_minute"] = _with("accel_all") + _minutes()
    sql["accel_daily_grid"] = _grid() + (
        "SELECT sensor_id, day, day_label, round(hour, 6) AS hour, round(v_avg, 6) AS v_avg, "
        "v_min, v_max FROM grid"
    )
    sql["accel_day_range"] = _grid() + (
        "SELECT sensor_id, day, min(v_min) AS y_min, max(v_max) AS y_max FROM grid GROUP BY ALL"
    )

    sql["fft_union"] = (
        fft + "SELECT hub, sensor_id, datetime, fft_main_f, fft_main_a, "
        "CAST(len(fft_freqs) AS INTEGER) AS n_freqs, list_max(fft_amps) AS amp_max FROM fft"
    )
    sql["fft_bounds"] = (
        fft + "SELECT sensor_id, min(datetime) AS start_dt, max(datetime) AS end_dt FROM fft GROUP BY 1"
    )
    recent = (
        "recent AS (SELECT * FROM fft JOIN (SELECT sensor_id, max(datetime) AS high FROM fft GROUP BY 1) "
        "USING (sensor_id) WHERE datetime BETWEEN high - INTERVAL 7 DAY AND high)"
    )
    sql["fft_points"] = (
        fft.rstrip() + f", {recent}, {_POINTS.format(source='recent')}\n"
        "SELECT sensor_id, freq, amp FROM points"
    )
    kde = fft.rstrip() + ",\n" + _kde(["sensor_id"], "fft")
    sql["fft_kde"] = kde + "SELECT sensor_id, k, round(x, 9) AS x, round(density, 9) AS density FROM kde"
    sql["fft_peak"] = kde + (
        "SELECT sensor_id, round(f_peak, 9) AS f_peak, round(density, 9) AS density, n_points, "
        "amp_min, amp_max FROM peaks"
    )
    sql["fft_main_series"] = fft + f"""SELECT sensor_id, {_bin(1440)} AS bin_start, 1440 AS bin_minutes,
  count(*) AS n_spectra, round(avg(fft_main_f), 6) AS f_avg, min(fft_main_f) AS f_min, max(fft_main_f) AS f_max,
  round(avg(fft_main_a), 6) AS a_avg, min(fft_main_a) AS a_min, max(fft_main_a) AS a_max
FROM fft GROUP BY 1, 2"""

    sql["diff_full_outer"] = _versions() + _diff_sides()
    sql["diff_except"] = _versions() + _diff_except()
    sql["timestamp_presence"] = _versions().rstrip() + """,
o AS (SELECT date_trunc('millisecond', datetime) AS ms, count(*) AS n FROM old GROUP BY 1),
n AS (SELECT date_trunc('millisecond', datetime) AS ms, count(*) AS n FROM new GROUP BY 1)
SELECT strftime(ms, '%Y-%m-%d %H:%M:%S.%g') AS timestamp, coalesce(o.n, 0) AS exists_in_old,
       coalesce(n.n, 0) AS exists_in_new FROM o FULL OUTER JOIN n USING (ms)"""
    sql["compare_tables"] = _compare()
    sql["compare_weeks"] = _compare_weeks()
    sql["schema_diff"] = _schema_diff()
    sql["coverage_missing"] = _coverage()
    sql["weekly_backfill"] = sql["backfill_changed_week"] = sql["partial_backfill"] = _backfill()

    sql["week_statistics"] = _statistics()
    sql["stored_last_7_days"] = sql["last_7_days"]
    sql["stored_fft_points"] = sql["fft_points"]
    sql["stored_time_bounds"] = sql["time_bounds"]
    sql["stored_coverage_missing"] = sql["coverage_missing"]
    sql["coverage_gaps"] = _gaps()
    sql["compare_week_contents"] = _week_contents()
    sql["differing_hours"] = _hours()
    sql["lookup_times"] = f"""WITH {_EVENTS}, hub2 AS ({_sst('hub2')})
SELECT * FROM hub2 WHERE date_trunc('millisecond', datetime) IN
  (SELECT date_trunc('millisecond', ts) FROM e WHERE event_type = 'error' AND k % 2 = 0)"""
    sql["stream_ingest_repeats"] = sql["stream_ingest"]
    sql["stream_accel_minute"] = _stream_minutes()
    sql["stream_late_rows"] = _late()
    sql["fft_kde_binned"] = kde + "SELECT sensor_id, k, round(x, 9) AS x, true AS within_bound FROM kde"
    minutely = "datetime >= (SELECT date_trunc('minute', max(datetime)) - INTERVAL 7 DAY FROM sst_hub1)"
    sql["partial_temps_col"] = _with("sst_hub1") + _means(col, 60, minutely, "sst_hub1")
    sql["partial_day_range"] = sql["accel_day_range"]
    sql["sketch_medians"] = _sketched()
    return sql
