"""sensorlake: a Spark-native telemetry lakehouse.

Raw sensor lines land as text files; they are parsed and validated, cut to
complete minutes, cleaned (batch quantile clipping + linear interpolation by
pooled row position), rolled up to one row per (minute, device), appended
idempotently to a minute table, and rolled up again into four hourly marts.
Everything is DataFrame / SQL / Structured Streaming; there are no Python UDFs.
"""

from sensorlake.schemas import FEATURES, KEYS  # noqa: F401

__version__ = "0.1.0"
