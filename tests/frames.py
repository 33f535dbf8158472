"""Hand-made snapshots."""

from datetime import date, timedelta

from fleetpulse.schema import RAW_ATTRIBUTES, SNAPSHOT

START = date(2025, 1, 1)


def snapshots(spark, rows):
    """Rows as dicts; absent attributes are 0, absent models 'M', capacity 4 TB."""
    out = []
    for r in rows:
        full = {"model": "M", "capacity_bytes": 4 * 10**12, "failure": 0, **dict.fromkeys(RAW_ATTRIBUTES, 0), **r}
        out.append(tuple(full[f.name] for f in SNAPSHOT))
    return spark.createDataFrame(out, SNAPSHOT)


def day(n):
    return START + timedelta(days=n)
