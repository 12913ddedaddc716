"""Join helpers that keep broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when it has at most this many rows.
LOOKUP_MAX_ROWS = 100_000
# Keys of an incoming batch are broadcast to probe a big table only up to
# this many rows (2M longs: tens of MB per executor).  A session may set
# ``spark.stockroom.probe.maxRows`` instead (0 forces the shuffled plans).
PROBE_MAX_ROWS = 2_000_000
PROBE_CONF = "spark.stockroom.probe.maxRows"


def probe_limit(spark, given: int | None = None) -> int:
    """The probe bound: an explicit argument, else the session setting,
    else ``PROBE_MAX_ROWS``."""
    if given is not None:
        return given
    v = spark.conf.get(PROBE_CONF, None)
    return int(v) if v not in (None, "") else PROBE_MAX_ROWS


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows.

    A distributed count (partial counts per task, one number to the
    driver).  ``limit(n).count()`` is avoided on purpose: it gathers up to
    ``n`` rows into a single partition.
    """
    return df.count() <= max_rows


def keys_present(big: DataFrame, probe: DataFrame, col: str, small_probe: bool,
                 key_range: tuple | None = None) -> DataFrame:
    """Distinct values of ``col`` in ``big`` that also occur in ``probe``.

    With ``small_probe`` (the caller has checked the probe's size) the
    probe is broadcast and ``big`` is only scanned, never shuffled; the
    result has at most as many rows as the probe.  Otherwise a shuffled
    semi join.

    ``key_range=(lo, hi)``, the probe's smallest and largest value, becomes
    a filter on ``big`` that reaches the parquet scan: row groups whose
    min/max statistics lie outside it are skipped (for keys that grow over
    time, such as new order numbers, that is almost all of them).
    """
    p = probe.select(col)
    b = big.select(col)
    if key_range is not None and key_range[0] is not None:
        b = b.filter(F.col(col).between(F.lit(key_range[0]), F.lit(key_range[1])))
    hits = b.join(F.broadcast(p) if small_probe else p, col, "left_semi")
    return hits.distinct()
