"""Measurement-shaped tables derived from ``events`` and ``nation``.

Input for the registered queries. The text is plain SQL that Spark and an
oracle engine read alike; both see 24 hourly batches with planted defects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MDT_SQL = """
SELECT event_id,
  CAST(1780000000000 + event_id*1000 AS DOUBLE) AS time_ms,
  CAST(CASE WHEN event_id % 61 = 3 AND event_id % 24 >= 4 THEN NULL
       WHEN event_id % 53 = 7 AND event_id % 24 >= 6 THEN -150
       ELSE -44 - (event_id*37) % 97 END AS INT) AS p_cell_rsrp,
  CASE WHEN event_id % 83 = 5 AND event_id % 24 >= 8 THEN 0.0e0
       ELSE -3.0e0 - ((event_id*13) % 35)/2.0e0 END AS p_cell_rsrq,
  CASE WHEN event_id % 71 = 1 AND event_id % 24 >= 10 THEN NULL
       WHEN event_id % 89 = 2 AND event_id % 24 >= 12 THEN 0.0e0
       ELSE 21.5e0 + ((user_id*31) % 40)/1000.0e0 + ((event_id*17) % 200)/100000.0e0 END AS lat,
  CASE WHEN event_id % 73 = 2 AND event_id % 24 >= 14 THEN NULL
       WHEN event_id % 79 = 8 AND event_id % 24 >= 22 THEN 110.0e0
       ELSE 105.8e0 + ((user_id*47) % 40)/1000.0e0 + ((event_id*29) % 200)/100000.0e0 END AS lng,
  concat('2026-05-05-', lpad(CAST(CASE WHEN event_id % 97 = 4 AND event_id % 24 >= 16
       THEN (event_id+1) % 24 ELSE event_id % 24 END AS STRING), 2, '0')) AS date_hour,
  CASE WHEN event_id % 101 = 6 AND event_id % 24 >= 18 THEN NULL
       WHEN event_id % 103 = 7 AND event_id % 24 >= 20 THEN ''
       ELSE concat('c', CAST(user_id % 40 AS STRING)) END AS cell_id,
  '2026-05-05' AS date, lpad(CAST(event_id % 24 AS STRING), 2, '0') AS hour
  FROM events
"""

CELL_INFO_SQL = """
SELECT concat('c', CAST(n_nationkey AS STRING)) AS cell_code,
  21.5e0 + ((n_nationkey*31) % 40)/1000.0e0 AS x_,
  105.8e0 + ((n_nationkey*47) % 40)/1000.0e0 AS y_ FROM nation
"""

DATE = "2026-05-05"


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema("event_id bigint, user_id bigint").parquet(
        f"{sf_dir}/events.parquet"
    )
    return spark.sql(MDT_SQL.replace("FROM events", "FROM {events}"), events=events)


def cell_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.schema("n_nationkey int").parquet(f"{sf_dir}/nation.parquet")
    return spark.sql(CELL_INFO_SQL.replace("FROM nation", "FROM {nation}"), nation=nation)
