"""Small frames for the tests."""

import csv
import os

from celltide import schemas
from celltide.schemas import Batch

GOOD = {
    "time_ms": 1.78e12,
    "p_cell_rsrp": -90,
    "p_cell_rsrq": -10.0,
    "lat": 21.55,
    "lng": 105.84,
    "province_name": "p",
    "district_name": "d",
    "date_hour": "2026-05-05-09",
    "cell_id": "a",
    "unreadable": None,
    "date": "2026-05-05",
    "hour": "09",
}

NINE = Batch("2026-05-05", "09")


def measurement(**changed):
    row = {**GOOD, **changed}
    if "date_hour" not in changed:
        row["date_hour"] = f"{row['date']}-{row['hour']}"
    return row


def frame(spark, rows, schema=schemas.RAW):
    data = [tuple(r[f.name] for f in schema) for r in rows]
    return spark.createDataFrame(data, schema)


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def land(folder, batch, rows, header=None):
    """Write an hour's landing file."""
    os.makedirs(folder, exist_ok=True)
    names = [f.name for f in schemas.LANDING]
    path = os.path.join(folder, f"mdt_records_{batch.key}.csv")
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header or names)
        for r in rows:
            writer.writerow(["" if r[n] is None else r[n] for n in names])
    return path
