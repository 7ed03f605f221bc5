"""The queries of the catalogue in plain SQL over the same tables, for checking.

The statements are put together from common table expressions; each result
has the column names of its query.
"""

from __future__ import annotations

from ..schemas import DETAIL_COLUMNS, SUMMARY

_RECORDS = """
details AS (
  SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS record_id,
         CAST(year(l.l_shipdate) AS INT) AS year,
         CAST(month(l.l_shipdate) AS INT) AS month,
         CAST(day(l.l_shipdate) AS INT) AS day,
         CASE WHEN p.p_size <= 2 THEN 'UNKNOWN' ELSE p.p_type END AS aircraft,
         CAST(CASE WHEN l.l_discount < 0.01 THEN NULL ELSE p.p_size END AS FLOAT) AS aircraft_mass,
         CASE WHEN l.l_linenumber >= 7 THEN NULL ELSE l.l_linenumber END AS engines,
         CASE WHEN s.s_suppkey % 20 = 0 THEN CAST(s.s_suppkey AS VARCHAR)
              ELSE concat('K', CAST(s.s_suppkey AS VARCHAR)) END AS airport_id,
         n.n_name AS airport_name,
         p.p_brand AS state,
         concat('R', CAST(n.n_regionkey AS VARCHAR)) AS faa_region,
         CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE l.l_tax > 0.04 END AS warning_issued,
         CASE WHEN l.l_linestatus = 'O' THEN '' ELSE 'CLIMB' END AS flight_phase,
         CASE WHEN p.p_name = 'red plate' THEN '100000000000'
              WHEN p.p_name = 'small widget' THEN 'UNKBS'
              ELSE concat('S', CAST(p.p_partkey AS VARCHAR)) END AS species_id,
         CASE WHEN p.p_name = 'red plate' THEN 'UNKNOWN'
              WHEN p.p_name = 'small widget' THEN 'UNKNOWN BIRD - SMALL'
              ELSE p.p_name END AS species_name,
         CASE WHEN l.l_quantity >= 49 THEN '' WHEN l.l_quantity >= 45 THEN 'Over 100'
              WHEN l.l_quantity >= 11 THEN '11-100' WHEN l.l_quantity >= 2 THEN '2-10' ELSE '1' END AS species_quantity,
         CAST(CASE WHEN l.l_discount < 0.04 THEN 0 END AS INT) AS fatalities,
         CAST(CASE WHEN l.l_tax >= 0.05 THEN 1 END AS INT) AS injuries,
         l.l_returnflag = 'R' AS aircraft_damage
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey
)"""

_SUMMARY = """
summary AS (
  SELECT *,
         CAST(CASE species_quantity WHEN '1' THEN 1 WHEN '2-10' THEN 2 WHEN '11-100' THEN 11
                                    WHEN 'Over 100' THEN 100 END AS INT) AS species_quantity_min,
         CAST(CASE species_quantity WHEN '1' THEN 1 WHEN '2-10' THEN 10 WHEN '11-100' THEN 100
                                    WHEN 'Over 100' THEN 10000 END AS INT) AS species_quantity_max
  FROM details
)"""

# failing rules per field and row, in the order of the rule table
_FAILURES = {
    "year": "(year IS NULL)::INT + (year NOT BETWEEN 1990 AND 2015)::INT",
    "month": "(month IS NULL)::INT + (month NOT BETWEEN 1 AND 12)::INT",
    "day": "(day IS NULL)::INT + (day NOT BETWEEN 1 AND 31)::INT",
    "aircraft": "contains(aircraft, 'UNKNOWN')::INT",
    "aircraft_mass": "(aircraft_mass IS NULL)::INT",
    "engines": "(engines IS NULL)::INT",
    "airport_id": "regexp_full_match(airport_id, '-?\\d+(\\.\\d+)?')::INT + contains(airport_id, 'UNKN')::INT",
    "airport_name": "(airport_name = '')::INT",
    "state": "(state = '')::INT",
    "faa_region": "(faa_region = '')::INT",
    "warning_issued": "(warning_issued IS NULL)::INT",
    "flight_phase": "(flight_phase = '')::INT",
    "species_id": "contains(species_id, '100000000000')::INT + contains(species_id, 'UNK')::INT",
    "species_name": "(species_name = '')::INT + contains(species_name, 'UNKNOWN')::INT",
    "species_quantity": "(species_quantity = '')::INT",
    "fatalities": "(fatalities IS NULL)::INT",
    "injuries": "(injuries IS NULL)::INT",
}

_PROFILE = "profile AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT '{field}' AS field, CAST(sum({count}) AS BIGINT) AS failures, count(*) AS total FROM details"
    for field, count in _FAILURES.items()
) + "\n)"

_KEPT = "kept AS (SELECT field FROM profile WHERE failures > 0 AND failures < total * 0.48)"

_PAIRS = """
pairs AS (
  SELECT 'airports' AS kind, airport_id AS id, airport_name AS name FROM {rows}
  UNION
  SELECT 'species', species_id, species_name FROM {rows}
)"""

_REPAIRS = """
names AS (SELECT DISTINCT kind, name FROM pairs),
canonical AS (
  SELECT p.kind, p.name, count(*) AS members,
         first(p.id ORDER BY length(p.id) DESC, p.id) FILTER (WHERE n.name IS NULL AND p.id IS NOT NULL) AS canonical
  FROM pairs p LEFT JOIN names n ON n.kind = p.kind AND n.name = p.id GROUP BY p.kind, p.name
),
swapped AS (
  SELECT p.kind, p.name, p.id, t.canonical AS true_id
  FROM pairs p
  JOIN canonical c ON c.kind = p.kind AND c.name = p.name AND c.members > 1
  JOIN canonical t ON t.kind = p.kind AND t.name = p.id
),
repaired_pairs AS (
  SELECT p.kind, p.id, p.name,
         coalesce((SELECT min(s.true_id) FROM swapped s WHERE s.kind = p.kind AND s.id = p.id),
                  CASE WHEN NOT EXISTS (SELECT 1 FROM swapped s WHERE s.kind = p.kind AND s.name = p.name)
                       THEN c.canonical END,
                  p.id) AS new_id,
         CASE WHEN EXISTS (SELECT 1 FROM swapped s WHERE s.kind = p.kind AND s.id = p.id AND s.true_id IS NOT NULL)
              THEN p.id ELSE p.name END AS new_name
  FROM pairs p JOIN canonical c ON c.kind = p.kind AND c.name = p.name
)"""

_REPAIRED = """
repaired AS (
  SELECT r.* REPLACE (a.new_id AS airport_id, a.new_name AS airport_name,
                      b.new_id AS species_id, b.new_name AS species_name)
  FROM {rows} r
  JOIN repaired_pairs a ON a.kind = 'airports' AND a.id = r.airport_id AND a.name = r.airport_name
  JOIN repaired_pairs b ON b.kind = 'species' AND b.id = r.species_id AND b.name = r.species_name
)"""


def _any_kept(fields: list[str]) -> str:
    tests = [f"('{field}' IN (SELECT field FROM kept) AND {_FAILURES[field]} > 0)" for field in fields]
    return "(" + " OR ".join(tests) + ")"


_SPECIES_FIELDS = ["species_id", "species_name"]
_OTHER_FIELDS = [f for f in _FAILURES if not f.startswith("species")]

_FLAGGED = f"""
flagged AS (
  SELECT *, {_any_kept(_SPECIES_FIELDS)} AS bad_species,
         {_any_kept(["species_quantity"])} AS bad_quantity,
         {_any_kept(_OTHER_FIELDS)} AS bad_other
  FROM repaired
),
clean AS (
  SELECT * FROM flagged WHERE NOT bad_species AND NOT bad_quantity AND NOT bad_other AND aircraft_damage
)"""

_GROUPED = """
grouped AS (
  SELECT year, month, species_id, species_name, aircraft_damage, count(*) AS incidents,
         CAST(coalesce(sum((CAST(species_quantity_min AS BIGINT) + species_quantity_max) // 2), 0) AS BIGINT) AS creatures
  FROM clean GROUP BY ALL
)"""


# the last count of each key in each window of 730 days that has closed
_WINDOWED = """
dated AS (
  SELECT *, make_date(year, month, day) - DATE '1970-01-01' AS age FROM clean
),
counted AS (
  SELECT year, month, species_id, species_name, aircraft_damage, age // 730 AS w,
         sum(count(*)) OVER (PARTITION BY year, month, species_id, species_name, aircraft_damage ORDER BY age // 730) AS last_count
  FROM dated GROUP BY year, month, species_id, species_name, aircraft_damage, age // 730
),
grouped AS (
  SELECT * FROM counted WHERE (w + 1) * 730 <= (SELECT max(age) FROM dated)
)"""


def _ranked(amount: str = "incidents") -> str:
    return f"""
totals AS (
  SELECT year, species_id, species_name, CAST(sum({amount}) AS BIGINT) AS amount FROM grouped GROUP BY ALL
),
ranked AS (
  SELECT CAST(place - 1 AS INT) AS index, year, species_id, species_name, amount FROM (
    SELECT *, row_number() OVER (PARTITION BY year ORDER BY amount DESC, species_id, species_name) AS place
    FROM totals) WHERE place <= 5
)"""


_SWAPPED_ROWS = """
misplaced AS (
  SELECT * REPLACE (CASE WHEN airport_id LIKE 'K%3'
                         THEN concat('NATION_', CAST((CAST(substring(airport_name, 8, 10) AS INT) + 1) % 25 AS VARCHAR))
                         ELSE airport_id END AS airport_id)
  FROM details
)"""

_AMBIGUOUS = """
sides AS (
  SELECT kind, 'name_to_ids' AS direction, name AS code, id AS member FROM pairs
  UNION ALL SELECT kind, 'id_to_names', id, name FROM pairs
),
ambiguous AS (
  SELECT kind, direction, code, member FROM (
    SELECT *, count(*) OVER (PARTITION BY kind, direction, code) AS members FROM sides) WHERE members > 1
)"""

_WINDOWS = """
windows AS (
  SELECT event_type, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start,
         CAST(epoch(date_trunc('day', ts)) AS BIGINT) + 86400 AS window_end,
         arg_max(value, event_id) AS value
  FROM events GROUP BY ALL
)"""

_COUNTED = """
counted AS (
  SELECT event_id, ts, user_id, event_type,
         count(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS running_count
  FROM events
),
last_counts AS (
  SELECT user_id, event_type, date_trunc('day', ts) AS day, max(running_count) AS running_count
  FROM counted GROUP BY ALL
)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in ctes) + "\n" + body


def _prepared(rows: str = "summary") -> list[str]:
    return [
        _RECORDS, _SUMMARY, _PROFILE, _KEPT, _PAIRS.format(rows="details"), _REPAIRS, _REPAIRED.format(rows=rows), _FLAGGED,
    ]


def _wide() -> str:
    """The raw record with all its columns, as ``csv_roundtrip`` derives them."""
    offered = {
        "record_id", "year", "month", "day", "aircraft", "aircraft_mass", "engines", "airport_id", "airport_name", "state",
        "faa_region", "warning_issued", "flight_phase", "species_id", "species_name", "species_quantity", "fatalities",
        "injuries", "aircraft_damage",
    }
    columns = []
    for place, (_, name, dtype) in enumerate(DETAIL_COLUMNS):
        if name in offered:
            columns.append(name)
        elif dtype == "boolean":
            step = f"((record_id + {place}) % 7)"
            columns.append(f"CASE WHEN {step} < 6 THEN {step} < 2 END AS {name}")
        elif dtype == "string":
            columns.append(f"concat('a \"b\", ', CAST(record_id % {place + 2} AS VARCHAR)) AS {name}")
        else:
            columns.append(f"CAST(record_id % {place + 2} AS {dtype}) AS {name}")
    return "SELECT " + ", ".join(columns) + " FROM details"


def _untyped_lines() -> str:
    """Lines of the raw record with a break in one text; every third lacks its last column."""
    names = [name for _, name, _ in DETAIL_COLUMNS]
    texts = []
    for _, name, dtype in DETAIL_COLUMNS:
        text = f"coalesce(CAST({name} AS VARCHAR), '')"
        long = "CASE WHEN record_id < 50 THEN repeat('x,\"', 33334) ELSE '' END"
        texts.append(f"operator || chr(10) || '\"x\",' || {long}" if name == "operator" else text)
    whole, narrow = (", '|', ".join(t) for t in (texts, texts[:-1]))
    return (
        f"SELECT '{'|'.join(names)}' AS line, CAST(1 AS BIGINT) AS n UNION ALL SELECT '{'|'.join(names[:-1])}', 1 "
        f"UNION ALL SELECT line, count(*) FROM (SELECT CASE WHEN record_id % 3 = 0 THEN concat({narrow}) ELSE concat({whole}) END AS line "
        f"FROM ({_wide()})) GROUP BY line"
    )


def _failing() -> str:
    """Distinct summaries without their record ids under each kept field that they fail; the quantity has become two."""
    columns = ", ".join(c for c in SUMMARY.fieldNames() if c != "record_id")
    parts = []
    for field, count in _FAILURES.items():
        names = [f"{field}_min", f"{field}_max"] if field == "species_quantity" else [field]
        test = f"'{field}' IN (SELECT field FROM kept) AND {count} > 0"
        parts += [f"SELECT DISTINCT {columns}, '{name}' AS field FROM repaired WHERE {test}" for name in names]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    summary = ", ".join(SUMMARY.fieldNames())
    codes = "record_id, airport_id, airport_name, species_id, species_name"
    ranked = [*_prepared(), _GROUPED, _ranked()]
    routed = _with(
        _prepared(),
        " UNION ALL ".join(
            f"SELECT {codes}, '{topic}' AS topic FROM flagged WHERE {flag}"
            for flag, topic in [
                ("bad_species", "quarantine-species"),
                ("bad_quantity", "quarantine-quantity"),
                ("bad_other", "quarantine-other"),
            ]
        ),
    )
    all_summaries = _with([_RECORDS, _SUMMARY], f"SELECT {summary} FROM summary")
    clean = _with(_prepared(), f"SELECT {summary} FROM clean")
    top = _with(ranked, "SELECT * FROM ranked ORDER BY year, index")
    counts = _with([*_prepared(), _GROUPED], "SELECT * FROM grouped")
    pairs = [_RECORDS, _PAIRS.format(rows="details")]
    bounds = "(SELECT epoch_us(min(ts)) AS low, (epoch_us(max(ts)) - epoch_us(min(ts))) // 4 AS quarter FROM events)"
    no_amount = "SELECT year, species_id, species_name, count(*) AS amount FROM details"
    return {
        "topn_per_year": top,
        "yearly_totals": _with(ranked, "SELECT * FROM totals"),
        "grouped_incidents": _with([*_prepared(), _GROUPED], "SELECT * EXCLUDE (creatures) FROM grouped"),
        "grouped_creatures": _with([*_prepared(), _GROUPED], "SELECT * EXCLUDE (incidents) FROM grouped"),
        "topn_creatures": _with([*_prepared(), _GROUPED, _ranked("creatures")], "SELECT * FROM ranked"),
        "clean_incidents": clean,
        "normalize_summary": all_summaries,
        "parse_quantity": _with(
            [_RECORDS, _SUMMARY],
            "SELECT species_quantity, species_quantity_min AS low, species_quantity_max AS high, "
            "(CAST(species_quantity_min AS BIGINT) + species_quantity_max) // 2 AS mean, count(*) AS n "
            "FROM summary GROUP BY ALL",
        ),
        "upper_ids": _with([_RECORDS], "SELECT record_id, upper(lower(species_id)) AS species_id FROM details"),
        "rule_profile": _with([_RECORDS, _PROFILE], "SELECT field, failures, total FROM profile"),
        "rule_selection": _with(
            [_RECORDS, _PROFILE],
            "SELECT CAST(t.threshold AS DOUBLE) AS threshold, n.name AS field FROM profile p, "
            "(VALUES (0.48), (0.05), (0.03)) t(threshold), LATERAL (SELECT unnest(CASE WHEN p.field = 'species_quantity' "
            "THEN ['species_quantity_min', 'species_quantity_max'] ELSE [p.field] END) AS name) n "
            "WHERE p.failures > 0 AND p.failures < p.total * t.threshold",
        ),
        "invalid_topics": _with(
            _prepared(),
            "SELECT record_id, concat_ws(',', CASE WHEN bad_species THEN 'species' END, "
            "CASE WHEN bad_quantity THEN 'quantity' END, CASE WHEN bad_other THEN 'other' END) AS topics FROM flagged",
        ),
        "route_fanout": routed,
        "dedup_rows": _with(_prepared(), _failing()),
        "id_name_map": _with(
            pairs,
            "SELECT kind, id, name FROM pairs WHERE kind NOT IN "
            "(SELECT kind FROM pairs GROUP BY kind, id HAVING count(*) > 1)",
        ),
        "multi_code": _with([*pairs, _AMBIGUOUS], "SELECT * FROM ambiguous"),
        "mapping_direction": _with(
            pairs,
            "SELECT kind, count(DISTINCT id) AS ids, count(DISTINCT name) AS names, "
            "CASE WHEN count(DISTINCT id) > count(DISTINCT name) THEN 'name_to_ids' "
            "WHEN count(DISTINCT id) < count(DISTINCT name) THEN 'id_to_names' END AS direction FROM pairs GROUP BY kind",
        ),
        "mapping_orientation": _with(
            [_RECORDS, _SWAPPED_ROWS, _PAIRS.format(rows="misplaced"), _AMBIGUOUS],
            "SELECT kind, direction, code, bool_and(says) AS is_id_to_name FROM (SELECT *, CASE "
            "WHEN code_id <> code_name AND member_id <> member_name "
            "THEN CASE WHEN code_id <> member_id THEN code_id END "
            "WHEN code_id <> code_name THEN code_id WHEN member_id <> member_name THEN member_name END AS says FROM ("
            "SELECT a.*, (kind, code) IN (SELECT (kind, id) FROM pairs) AS code_id, "
            "(kind, code) IN (SELECT (kind, name) FROM pairs) AS code_name, "
            "(kind, member) IN (SELECT (kind, id) FROM pairs) AS member_id, "
            "(kind, member) IN (SELECT (kind, name) FROM pairs) AS member_name FROM ambiguous a)) GROUP BY ALL",
        ),
        "unknown_species": _with(
            pairs,
            "SELECT 'id' AS role, id AS code FROM pairs WHERE kind = 'species' AND contains(id, 'UNK') UNION ALL "
            "SELECT 'name', name FROM pairs WHERE kind = 'species' AND contains(name, 'UNKNOWN')",
        ),
        "canonical_id_sync": _with(_prepared(), f"SELECT {codes} FROM repaired"),
        "swapped_codes": _with(
            [_RECORDS, _SWAPPED_ROWS, _PAIRS.format(rows="misplaced"), _REPAIRS, _REPAIRED.format(rows="misplaced")],
            f"SELECT {codes} FROM repaired",
        ),
        "distinct_by_key": _with(
            [_RECORDS],
            "SELECT year, species_id, species_name, amount FROM (SELECT *, row_number() OVER "
            "(PARTITION BY year, species_name ORDER BY amount DESC, species_id) AS place FROM "
            f"({no_amount} GROUP BY ALL)) WHERE place = 1",
        ),
        "merge_topn": _with(
            [_RECORDS],
            "SELECT CAST(place - 1 AS INT) AS index, year, species_id, species_name, amount FROM (SELECT *, row_number() "
            "OVER (PARTITION BY year ORDER BY amount DESC, species_id, species_name) AS place FROM "
            f"({no_amount} GROUP BY ALL)) WHERE place <= 5",
        ),
        "topn_nested": top,
        "latest_by_key": "SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL",
        "tumbling_last": _with([_WINDOWS], "SELECT * FROM windows"),
        "running_count": _with([_COUNTED], "SELECT event_id, user_id, event_type, running_count FROM counted"),
        "windowed_last_sum": _with(
            [_COUNTED], "SELECT event_type, CAST(sum(running_count) AS BIGINT) AS total FROM last_counts GROUP BY ALL"
        ),
        "csv_roundtrip": _with([_RECORDS], _wide()),
        "csv_untyped": _with(
            [_RECORDS],
            _untyped_lines(),
        ),
        "csv_sink": top,
        "json_roundtrip": all_summaries,
        "envelope": _with(
            [_RECORDS],
            "SELECT record_id, year, month, species_id, species_name, aircraft_damage, 'Key' AS header, "
            "CAST(36 AS INT) AS uuid_length FROM details",
        ),
        "stream_source": all_summaries,
        "stream_static": routed,
        "replay_equals_batch": clean,
        "stream_grouped": counts,
        "grouped_topics": _with(
            [*_prepared(), _GROUPED],
            "SELECT * EXCLUDE (incidents, creatures), 'incidents' AS measure, incidents AS amount FROM grouped "
            "UNION ALL SELECT * EXCLUDE (incidents, creatures), 'creatures', creatures FROM grouped",
        ),
        "replay_idempotent": _with([*_prepared(), _GROUPED], "SELECT *, CAST(0 AS BIGINT) AS doubled FROM grouped"),
        "stream_topn": top,
        "snapshot_sink": _with(ranked, "SELECT *, 'counts' AS output FROM ranked UNION ALL SELECT *, 'ranking' FROM ranked"),
        "stream_windowed_topn": _with([*_prepared(), _WINDOWED, _ranked("last_count")], "SELECT * FROM ranked"),
        "stream_tumbling": _with(
            [_WINDOWS], "SELECT * FROM windows WHERE window_end <= (SELECT epoch(max(ts)) FROM events)"
        ),
        "stream_windowed_last_sum": _with(
            [_COUNTED],
            "SELECT event_type, CAST(sum(running_count) AS BIGINT) AS total FROM last_counts "
            "WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) GROUP BY ALL",
        ),
        "late_drop": (
            "SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, event_type, count(*) AS n "
            f"FROM events, {bounds} WHERE epoch_us(ts) >= low + 2 * quarter "
            "AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) GROUP BY ALL"
        ),
    }
