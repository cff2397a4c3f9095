"""Experiment naming: a wall-clock stamp in a time zone and the experiment path."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the original flow: stamp format and zone.
STAMP_FORMAT_SPARK = "yyyyMMdd_HHmmss"
STAMP_FORMAT_PY = "%Y%m%d_%H%M%S"
STAMP_ZONE = "Europe/Rome"
EXPERIMENT_PREFIX = "iris_"


def zone_stamp(ts_utc: str | Column, zone: str = STAMP_ZONE) -> Column:
    """Render a UTC wall-clock timestamp (timestamp_ntz) in ``zone`` as yyyyMMdd_HHmmss."""
    ts = F.col(ts_utc) if isinstance(ts_utc, str) else ts_utc
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return F.date_format(local, STAMP_FORMAT_SPARK)


def experiment_path(base: str | Column, name: str | Column, stamp: str | Column,
                    prefix: str = EXPERIMENT_PREFIX) -> Column:
    """``base/<prefix><lower(name)>_<stamp>``."""
    def c(v):
        return F.lit(v) if isinstance(v, str) else v
    leaf = F.concat(F.lit(prefix), F.lower(c(name)), F.lit("_"), c(stamp))
    return F.concat_ws("/", c(base), leaf)


def now_stamp(zone: str = STAMP_ZONE, now: datetime | None = None) -> str:
    """Driver-side stamp for naming one experiment (same format as ``zone_stamp``)."""
    t = now or datetime.now(ZoneInfo("UTC"))
    return t.astimezone(ZoneInfo(zone)).strftime(STAMP_FORMAT_PY)


def experiment_name(base: str, model_name: str, stamp: str,
                    prefix: str = EXPERIMENT_PREFIX) -> str:
    return f"{base.rstrip('/')}/{prefix}{model_name.lower()}_{stamp}"
