"""Oracle SQL for the registered queries, in terms of the driver's tables.

Written the direct way (window averages, one scan per rule) rather than the
way the operators run, so that the two check each other.
"""

from __future__ import annotations

from celltide.operators.serve import SIGNAL_COLOURS
from celltide.sources.derived import CELL_INFO_SQL, DATE, MDT_SQL

_CONDITION = """lat IS NOT NULL AND lng IS NOT NULL AND lat <> 0.0e0
    AND lat BETWEEN 8.5e0 AND 23.4e0 AND lng BETWEEN 102.1e0 AND 109.5e0
    AND p_cell_rsrp BETWEEN -140 AND -44 AND p_cell_rsrq BETWEEN -20.0e0 AND -3.0e0
    AND date_hour = concat(date, '-', hour)"""


def _round(value: str, digits: int) -> str:
    """Half-up on the decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 12)), {digits}) AS DOUBLE)"


def _nudged(value: str, digits: int) -> str:
    """Rounded off the ties that means of short decimals sit on, as the queries do."""
    return _round(f"({value}) + 1e-9", digits)


def _hexes(source: str) -> str:
    """Axial cell of each position: project, round the cube, mend the worst component."""
    return f"""
SELECT *, CASE WHEN q IS NULL OR r IS NULL THEN NULL
         ELSE concat('hx9_', CAST(q AS VARCHAR), '_', CAST(r AS VARCHAR)) END AS h3_index
FROM (SELECT *,
    CASE WHEN abs(rq - fq) > abs(rr - fr) AND abs(rq - fq) > abs(rs + fq + fr)
         THEN -rr - rs ELSE rq END AS q,
    CASE WHEN abs(rq - fq) > abs(rr - fr) AND abs(rq - fq) > abs(rs + fq + fr) THEN rr
         WHEN abs(rr - fr) > abs(rs + fq + fr) THEN -rq - rs ELSE rr END AS r
  FROM (SELECT *, CAST(floor(fq + 0.5e0) AS BIGINT) AS rq, CAST(floor(fr + 0.5e0) AS BIGINT) AS rr,
      CAST(floor(0.5e0 - fq - fr) AS BIGINT) AS rs
    FROM (SELECT *, (sqrt(3.0e0) / 3.0e0 * px - py / 3.0e0) / 0.200786e0 AS fq,
        (2.0e0 / 3.0e0 * py) / 0.200786e0 AS fr
      FROM (SELECT *, 6371.0e0 * cos(radians(16.0e0)) * radians(lng) AS px,
          6371.0e0 * sin(radians(lat)) / cos(radians(16.0e0)) AS py
        FROM {source}))))"""


_HALF_CHORD = """pow(sin(radians(cell_lat - lat) / 2.0e0), 2.0e0)
    + cos(radians(lat)) * cos(radians(cell_lat)) * pow(sin(radians(cell_lon - lng) / 2.0e0), 2.0e0)"""

_COSINE = """sin(radians(lat)) * sin(radians(cell_lat))
    + cos(radians(lat)) * cos(radians(cell_lat)) * cos(radians(cell_lon - lng))"""

_X = "0.200786e0 * (sqrt(3.0e0) * q + sqrt(3.0e0) / 2.0e0 * r)"
_Y = "1.5e0 * 0.200786e0 * r"


def _lng(x: str) -> str:
    return f"degrees(({x}) / (6371.0e0 * cos(radians(16.0e0))))"


def _lat(y: str) -> str:
    return f"degrees(asin(({y}) * cos(radians(16.0e0)) / 6371.0e0))"


_CENTRE = f"{_lat(_Y)} AS h3_center_lat, {_lng(_X)} AS h3_center_lon"


def _outline() -> str:
    corners = [
        "printf('%.7f %.7f', {}, {})".format(
            _lng(f"{_X} + 0.200786e0 * sin(radians({-60 * k}.0e0))"),
            _lat(f"{_Y} + 0.200786e0 * cos(radians({-60 * k}.0e0))"),
        )
        for k in (0, 1, 2, 3, 4, 5, 0)
    ]
    return f"concat('POLYGON((', concat_ws(', ', {', '.join(corners)}), '))') AS h3_wkt"


_INDICATORS = f"""count(*) AS user_density_count,
    {_round("avg(p_cell_rsrp)", 2)} AS avg_rsrp,
    quantile_disc(p_cell_rsrp, 0.1) AS p10_rsrp,
    {_round("avg(distance_to_cell_km)", 2)} AS avg_distance_km,
    {_round("avg(CASE WHEN p_cell_rsrp < -110 THEN 1 ELSE 0 END)", 4)} AS weak_signal_ratio"""

_RULES = {
    "lat_not_null": ("completeness", "lat IS NULL"),
    "lng_not_null": ("completeness", "lng IS NULL"),
    "cell_id_not_null": ("completeness", "cell_id IS NULL"),
    "cell_id_length": ("completeness", "length(cell_id) < 1"),
    "p_cell_rsrp_range": ("validity", "p_cell_rsrp NOT BETWEEN -140 AND -44"),
    "p_cell_rsrq_range": ("validity", "p_cell_rsrq NOT BETWEEN -20.0e0 AND -3.0e0"),
    "lat_range": ("accuracy", "lat NOT BETWEEN 8.5e0 AND 23.4e0"),
    "lng_range": ("accuracy", "lng NOT BETWEEN 102.1e0 AND 109.5e0"),
    "lat_not_in_set": ("accuracy", "lat IN (0.0e0)"),
    "date_hour_in_set": ("consistency", "date_hour NOT IN (concat(date, '-', hour))"),
}

_ORDER_RULES = {
    "o_custkey_not_null": ("completeness", "o_custkey IS NULL"),
    "o_totalprice_range": ("validity", "o_totalprice NOT BETWEEN 1000.0e0 AND 400000.0e0"),
    "o_orderpriority_length": ("completeness", "length(o_orderpriority) NOT BETWEEN 5 AND 8"),
    "o_orderpriority_in_set": (
        "consistency",
        "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    ),
    "o_orderstatus_not_in_set": ("accuracy", "o_orderstatus IN ('P')"),
}


def _violations(table: str, keys: str, rules: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{name}' AS rule, '{dimension}' AS dimension, "
        f"count(*) FILTER (WHERE {broken}) AS violations, "
        f"count(*) FILTER (WHERE {broken}) = 0 AS passed FROM {table} GROUP BY {keys}"
        for name, (dimension, broken) in rules.items()
    )


_SPLIT = f"""SELECT date, hour, count(*) AS total_raw_records,
    count(*) FILTER (WHERE {_CONDITION}) AS clean_count,
    count(*) FILTER (WHERE NOT coalesce({_CONDITION}, false)) AS dirty_count,
    count(*) FILTER (WHERE ({_CONDITION}) IS NULL) AS undecided_count
  FROM mdt GROUP BY date, hour"""

_PARTS = {
    "mdt": MDT_SQL,
    "cell_info": CELL_INFO_SQL,
    "clean": f"SELECT * FROM mdt WHERE {_CONDITION}",
    "sited": """SELECT clean.*, x_ AS cell_lat_known, y_ AS cell_lon_known
      FROM clean LEFT JOIN cell_info ON cell_id = cell_code""",
    "filled": """SELECT *,
        coalesce(cell_lat_known, avg(lat) OVER (PARTITION BY date, hour, cell_id)) AS cell_lat,
        coalesce(cell_lon_known, avg(lng) OVER (PARTITION BY date, hour, cell_id)) AS cell_lon,
        CASE WHEN cell_lat_known IS NULL OR cell_lon_known IS NULL THEN 'estimated'
             ELSE 'master' END AS cell_pos_source
      FROM sited""",
    "measured": f"""SELECT *, 2.0e0 * 6371.0e0 * asin(sqrt(least(1.0e0, {_HALF_CHORD})))
        AS distance_to_cell_km FROM filled""",
    "enriched": _hexes("measured"),
    "gold": f"""SELECT date, hour, h3_index, cell_id, q, r, {_INDICATORS},
        min(cell_lat) AS cell_lat, min(cell_lon) AS cell_lon
      FROM enriched GROUP BY date, hour, h3_index, cell_id, q, r""",
    "mapped": f"""SELECT *, {_CENTRE},
        CAST(concat(date, ' ', hour, ':00:00') AS TIMESTAMP) AS record_time FROM gold""",
    "cells": f"SELECT DISTINCT h3_index, q, r FROM ({_hexes('clean')})",
    "violations": _violations("mdt", "date, hour", _RULES),
    "score": """SELECT date, hour, count(*) AS evaluated,
        count(*) FILTER (WHERE NOT passed) AS failed,
        count(*) FILTER (WHERE passed) * 100.0e0 / count(*) AS success_percent,
        bool_and(passed) AS success
      FROM violations GROUP BY date, hour""",
    "split": _SPLIT,
}

_USES = {
    "clean": ["mdt"],
    "sited": ["clean", "cell_info"],
    "filled": ["sited"],
    "measured": ["filled"],
    "enriched": ["measured"],
    "gold": ["enriched"],
    "mapped": ["gold"],
    "cells": ["clean"],
    "violations": ["mdt"],
    "score": ["violations"],
    "split": ["mdt"],
}


def _with(query: str, *parts: str) -> str:
    """Put the named parts, and all they need, in front of a query."""
    needed: list[str] = []

    def need(part: str) -> None:
        for other in _USES.get(part, []):
            need(other)
        if part not in needed:
            needed.append(part)

    for part in parts:
        need(part)
    return "WITH " + ",\n".join(f"{p} AS ({_PARTS[p]})" for p in needed) + "\n" + query


def _six(*columns: str) -> str:
    return ", ".join(f"{_nudged(c, 6)} AS {c}" for c in columns)


_ENDS = _six("cell_lat", "cell_lon", "h3_center_lat", "h3_center_lon")
_KPIS = "user_density_count, avg_rsrp, p10_rsrp, avg_distance_km, weak_signal_ratio"

_AUDIT = """SELECT date, hour, total_raw_records, CAST(0 AS BIGINT) AS duplicate_count,
    clean_count, {dirty} AS dirty_count, {more} success_percent AS gx_success_rate,
    evaluated AS gx_total_rules, failed AS gx_failed_rules, success AS gx_is_passed
  FROM split JOIN score USING (date, hour)"""

_UNSURE = "undecided_count, CAST(0 AS BIGINT) AS unreadable_count,"

_CLASS = """CASE WHEN avg_rsrp >= -60.0e0 THEN 6 WHEN avg_rsrp >= -76.0e0 THEN 5
    WHEN avg_rsrp >= -92.0e0 THEN 4 WHEN avg_rsrp >= -108.0e0 THEN 3
    WHEN avg_rsrp >= -124.0e0 THEN 2 ELSE 1 END"""

_COLOUR = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(SIGNAL_COLOURS, 1))

# Turned back by whole turns, in the arithmetic that the grid uses.
_TURNED = "(lng {} + 180.0e0) - 360.0e0 * floor((lng {} + 180.0e0) / 360.0e0) - 180.0e0"

_ODD_POSITIONS = f"""(SELECT * REPLACE (CASE event_id % 97
      WHEN 6 THEN {_TURNED.format('+ 360.0e0', '+ 360.0e0')}
      WHEN 7 THEN {_TURNED.format('- 720.0e0', '- 720.0e0')} ELSE lng END AS lng),
    event_id % 97 AS case_of FROM mdt)"""

# A CSV reader takes an empty text for null, so landed measurements have no empty cell id.
_EMPTY_CELL, _NO_CELL = "THEN ''", "THEN NULL"

ORACLES: dict[str, str] = {
    "src_csv_landing": _with(
        """SELECT time_ms, p_cell_rsrp, p_cell_rsrq, lat, lng,
           CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS district_name,
           date_hour, nullif(cell_id, '') AS cell_id, CAST(NULL AS VARCHAR) AS unreadable,
           date, hour FROM mdt""",
        "mdt",
    ),
    "src_csv_decimals": _with(
        """SELECT date, hour, count(*) AS n_rows,
           count(*) FILTER (WHERE long OR short OR odd) AS n_unreadable,
           count(p_cell_rsrp) FILTER (WHERE NOT odd) AS n_signals,
           CAST(sum(p_cell_rsrp) FILTER (WHERE NOT odd) AS BIGINT) AS sum_signal,
           count(nullif(cell_id, '')) FILTER (WHERE long OR NOT short) AS n_cells
         FROM (SELECT *, event_id % 29 = 5 AS odd, event_id % 31 = 7 AS long,
             event_id % 37 = 9 AS short FROM mdt)
         GROUP BY date, hour""",
        "mdt",
    ),
    "src_csv_headers": _with(
        """SELECT time_ms, p_cell_rsrp, p_cell_rsrq, lat, lng,
           CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS district_name, date_hour,
           CASE WHEN CAST(hour AS INT) % 5 <> 2 THEN nullif(cell_id, '') END AS cell_id,
           CAST(NULL AS VARCHAR) AS unreadable, date, hour,
           CASE WHEN CAST(hour AS INT) % 5 = 3 THEN concat('op', CAST(event_id % 3 AS VARCHAR)) END AS operator
         FROM mdt WHERE hour <> '23'""",
        "mdt",
    ),
    "snk_compact": _with(
        """SELECT date, hour, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_event_id,
           CAST(1 AS BIGINT) AS n_files FROM mdt GROUP BY date, hour""",
        "mdt",
    ),
    "flt_box": _with(
        """SELECT * FROM mdt WHERE lat BETWEEN 21.505e0 AND 21.521e0
           AND lng BETWEEN 105.805e0 AND 105.832e0""",
        "mdt",
    ),
    "dq_reconcile": _with(
        """SELECT date, hour, count(*) AS rows_before,
           CAST(count(*) - count(*) FILTER (WHERE event_id = 243) + count(*) FILTER (WHERE event_id = 245) AS BIGINT)
             AS rows_after,
           count(*) FILTER (WHERE event_id IN (243, 245, 247)) = 0 AS equal
         FROM mdt GROUP BY date, hour""",
        "mdt",
    ),
    "dq_repeats": _with(
        """SELECT date, hour, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n) - count(*) AS BIGINT) AS repeated_rows
         FROM (SELECT m.*, count(*) AS n FROM (
             SELECT * FROM mdt UNION ALL SELECT * FROM mdt WHERE event_id % 10 = 0
             UNION ALL SELECT mdt.* FROM mdt, range(999) WHERE event_id = 31) m GROUP BY ALL)
         GROUP BY date, hour""",
        "mdt",
    ),
    "gold_day_from_hours": _with(
        f"SELECT date, h3_index, cell_id, {_INDICATORS} FROM enriched GROUP BY date, h3_index, cell_id",
        "enriched",
    ),
    "gold_hex_from_states": _with(
        f"SELECT date, hour, h3_index, {_INDICATORS} FROM enriched GROUP BY date, hour, h3_index",
        "enriched",
    ),
    "gold_p10_sketch": """SELECT o_orderpriority, count(o_totalprice) AS n, true AS within_error
         FROM orders GROUP BY o_orderpriority""",
    "src_missing_table": _with(
        """SELECT 'written' AS name, true AS present, count(*) AS n_rows FROM mdt WHERE hour < '06'
           UNION ALL SELECT 'never', false, CAST(0 AS BIGINT)""",
        "mdt",
    ),
    "prj_processing_time": _with(
        """SELECT date, hour, count(*) AS n_rows, count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_times
           FROM mdt GROUP BY date, hour""",
        "mdt",
    ),
    "dq_console_lines": _with(
        """SELECT date, hour, printf(
             '%s %s: %d rows, %d clean, %d quarantined, %d undecided, 0 unreadable, score %.2f%% (%d of %d rules failed)',
             date, hour, total_raw_records, clean_count, dirty_count, undecided_count, success_percent, failed, evaluated)
             AS line
           FROM split JOIN score USING (date, hour)""",
        "split",
        "score",
    ),
    "prj_array_element": _with(
        """SELECT date, hour, h3_index, cell_id, min(p_cell_rsrp) AS weakest_rsrp, max(p_cell_rsrp) AS strongest_rsrp
           FROM enriched GROUP BY date, hour, h3_index, cell_id""",
        "enriched",
    ),
    "ops_fates": _with(
        """SELECT date, hour, CASE hour WHEN '04' THEN 'empty' WHEN '05' THEN 'unmappable' ELSE
             CASE WHEN success_percent >= 50.0e0 THEN 'passed' ELSE 'blocked' END END AS fate FROM score
           UNION ALL SELECT '2026-05-06', '00', 'missing'""",
        "score",
    ).replace(_EMPTY_CELL, _NO_CELL),
    "src_partition_scan": _with("SELECT * FROM mdt WHERE hour = '09'", "mdt"),
    "src_cell_sites": _with(
        "SELECT cell_code AS cell_id, x_ AS cell_lat, y_ AS cell_lon FROM cell_info", "cell_info"
    ),
    "snk_replace_partition": _with(
        """SELECT * FROM mdt WHERE hour NOT IN ('05', '07')
           UNION ALL SELECT * FROM clean WHERE hour = '05'""",
        "mdt",
        "clean",
    ),
    "snk_schema_evolve": _with(
        """SELECT h3_index, cell_id, user_density_count, date, hour,
           CASE WHEN hour >= '12' THEN weak_signal_ratio END AS weak_signal_ratio FROM gold""",
        "gold",
    ),
    "publish_gold_rows": _with(
        f"SELECT date, hour, h3_index, cell_id, {_KPIS}, {_ENDS}, {_outline()} FROM mapped",
        "mapped",
    ),
    "publish_audit_rows": _with(_AUDIT.format(dirty="dirty_count", more=""), "split", "score"),
    "prj_batch_columns": _with(
        f"SELECT event_id, date_hour, '{DATE}' AS date, '09' AS hour FROM mdt", "mdt"
    ),
    "prj_try_cast_positions": _with(
        """SELECT event_id, TRY_CAST(coalesce(CAST(lat AS VARCHAR), 'n/a') AS DOUBLE) AS lat,
           TRY_CAST(coalesce(CAST(lng AS VARCHAR), '') AS DOUBLE) AS lng FROM mdt""",
        "mdt",
    ),
    "prj_record_time": _with(
        """SELECT event_id, CAST(concat(date, ' ', hour, ':00:00') AS TIMESTAMP) AS record_time
           FROM mdt""",
        "mdt",
    ),
    "flt_clean": _with("SELECT * FROM clean", "clean"),
    "flt_time_range": _with(
        f"""SELECT h3_index, cell_id, user_density_count, avg_rsrp, date, hour FROM mapped
           WHERE record_time BETWEEN TIMESTAMP '{DATE} 06:00:00' AND TIMESTAMP '{DATE} 11:00:00'""",
        "mapped",
    ),
    "dq_rule_violations": _with("SELECT * FROM violations", "violations"),
    "dq_summary": _with("SELECT * FROM score", "score"),
    "dq_split_counts": _with(
        "SELECT date, hour, total_raw_records, clean_count, dirty_count FROM split", "split"
    ),
    "dq_quarantine": _with(f"SELECT * FROM mdt WHERE NOT coalesce({_CONDITION}, false)", "mdt"),
    "dq_quarantine_drop": _with(f"SELECT * FROM mdt WHERE NOT ({_CONDITION})", "mdt"),
    "dq_null_dropped": _with("SELECT date, hour, undecided_count FROM split", "split"),
    "dq_report": _with(
        _AUDIT.format(dirty="dirty_count - undecided_count", more=_UNSURE), "split", "score"
    ),
    "dq_gate": _with(
        """SELECT date, hour, success_percent AS success_rate,
           success_percent < 50.0e0 AS blocked FROM score""",
        "score",
    ),
    "dq_generic_orders": _violations("orders", "o_orderstatus", _ORDER_RULES),
    "geo_hex_bin": _with(
        f"""SELECT event_id, CASE WHEN case_of NOT BETWEEN 1 AND 5 THEN h3_index END AS h3_index
           FROM ({_hexes(_ODD_POSITIONS)})""",
        "mdt",
    ),
    "geo_hex_center": _with(
        f"""SELECT h3_index, {_nudged(_lat(_Y), 7)} AS h3_center_lat,
           {_nudged(_lng(_X), 7)} AS h3_center_lon FROM cells""",
        "cells",
    ),
    "geo_hex_wkt": _with(f"SELECT h3_index, {_outline()} FROM cells", "cells"),
    "geo_distance": _with(
        f"SELECT event_id, {_six('distance_to_cell_km')} FROM measured", "measured"
    ),
    "geo_distance_slc": _with(
        f"""SELECT event_id, {_round(
            f"6371.0e0 * acos(greatest(-1.0e0, least(1.0e0, {_COSINE})))", 2
        )} AS distance_to_cell_km FROM filled""",
        "filled",
    ),
    "enr_left_join": _with(
        """SELECT event_id, cell_id, cell_lat_known AS cell_lat, cell_lon_known AS cell_lon
           FROM sited""",
        "sited",
    ),
    "enr_unmatched_cells": _with(
        """SELECT cell_id, count(*) AS samples FROM clean
           WHERE cell_id IS NOT NULL AND cell_id NOT IN (SELECT cell_code FROM cell_info)
           GROUP BY cell_id""",
        "clean",
        "cell_info",
    ),
    "enr_cell_centroid": _with(
        f"""SELECT date, hour, cell_id, {_nudged('avg(lat)', 6)} AS est_cell_lat,
           {_nudged('avg(lng)', 6)} AS est_cell_lon FROM clean GROUP BY date, hour, cell_id""",
        "clean",
    ),
    "enr_fill_site": _with(
        f"SELECT event_id, cell_id, {_six('cell_lat', 'cell_lon')}, cell_pos_source FROM filled",
        "filled",
    ),
    "enr_fill_site_large": _with(
        f"SELECT event_id, cell_id, {_six('cell_lat', 'cell_lon')}, cell_pos_source FROM filled",
        "filled",
    ),
    "enr_fill_site_skewed": _with(
        f"SELECT event_id, cell_id, {_six('cell_lat', 'cell_lon')}, cell_pos_source FROM filled",
        "filled",
    ).replace(
        "sited AS (SELECT clean.*, x_",
        """crowded AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'c30' ELSE cell_id END
          AS cell_id) FROM clean),
sited AS (SELECT clean.*, x_""",
    ).replace("FROM clean LEFT JOIN cell_info", "FROM crowded AS clean LEFT JOIN cell_info"),
    "gold_kpi": _with(f"SELECT date, hour, h3_index, cell_id, {_KPIS} FROM gold", "gold"),
    "gold_kpi_coords": _with(
        f"SELECT date, hour, h3_index, cell_id, {_KPIS}, {_ENDS} FROM mapped", "mapped"
    ),
    "gold_p10_per_cell": _with(
        "SELECT cell_id, quantile_disc(p_cell_rsrp, 0.1) AS p10_rsrp FROM clean GROUP BY cell_id",
        "clean",
    ),
    "gold_weak_share_per_cell": _with(
        f"""SELECT cell_id, {_round('avg(CASE WHEN p_cell_rsrp < -110 THEN 1 ELSE 0 END)', 4)}
           AS weak_signal_ratio FROM clean GROUP BY cell_id""",
        "clean",
    ),
    "gold_by_hex": _with(
        f"SELECT date, hour, h3_index, {_INDICATORS} FROM enriched GROUP BY date, hour, h3_index",
        "enriched",
    ),
    "gold_by_cell": _with(
        f"SELECT date, hour, cell_id, {_INDICATORS} FROM enriched GROUP BY date, hour, cell_id",
        "enriched",
    ),
    "serve_map_day": _with(
        f"""SELECT h3_index, cell_id, user_density_count AS user_density, avg_rsrp, record_time,
           {_ENDS} FROM mapped WHERE date = '{DATE}' ORDER BY hour""",
        "mapped",
    ),
    "serve_arcs": _with(
        f"""SELECT {_nudged('cell_lat', 6)} AS lat0, {_nudged('cell_lon', 6)} AS lng0,
           {_nudged('h3_center_lat', 6)} AS lat1, {_nudged('h3_center_lon', 6)} AS lng1,
           user_density_count AS user_density, avg_rsrp, record_time FROM mapped
           WHERE cell_lat IS NOT NULL AND cell_lon IS NOT NULL
             AND h3_center_lat IS NOT NULL AND h3_center_lon IS NOT NULL""",
        "mapped",
    ),
    "serve_signal_class": _with(
        f"""SELECT h3_index, cell_id, record_time, avg_rsrp, {_CLASS} AS signal_class,
           CASE {_CLASS} {_COLOUR} END AS signal_colour FROM mapped""",
        "mapped",
    ),
    "serve_audit_day": _with(
        _AUDIT.format(dirty="dirty_count", more=_UNSURE) + f" WHERE date = '{DATE}' ORDER BY hour",
        "split",
        "score",
    ),
    "ops_backfill_counts": _with(
        """SELECT s.date, s.hour, success_percent AS success_rate,
           success_percent < 50.0e0 AS blocked, total_raw_records, clean_count, dirty_count,
           CAST(coalesce(gold_rows, 0) AS BIGINT) AS gold_rows,
           CAST(coalesce(gold_samples, 0) AS BIGINT) AS gold_samples
         FROM split s JOIN score c ON s.date = c.date AND s.hour = c.hour
         LEFT JOIN (SELECT date, hour, count(*) AS gold_rows,
             sum(user_density_count) AS gold_samples FROM gold GROUP BY date, hour) g
           ON g.date = s.date AND g.hour = s.hour AND success_percent >= 50.0e0""",
        "split",
        "score",
        "gold",
    ).replace(_EMPTY_CELL, _NO_CELL),
}

ORACLES["ops_stagewise_counts"] = ORACLES["ops_backfill_counts"]

# two hours delivered anew, without every fifth row
_RESTATED = ORACLES["ops_backfill_counts"].replace(
    "FROM events", "FROM (SELECT * FROM events WHERE event_id % 24 NOT IN (3, 8) OR event_id % 5 <> 0)"
)
ORACLES["ops_restated_counts"] = f"SELECT *, hour IN ('03', '08') AS restated FROM ({_RESTATED})"
