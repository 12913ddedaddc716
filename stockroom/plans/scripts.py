"""O9 in SQL: storing procedures as SQL scripts.

A session that only speaks SQL runs the text of ``script(...)`` (``spark-sql -f``,
a notebook, ``spark.sql``).  It gives every row of a batch view its verdict, by
the rules of ``operators.admission``, and stores all of them with one
``CREATE TABLE ... AS``, apart by verdict: a script that fails leaves no table, and
may be run again.  A temporary view then shows the table after the call: the
existing rows and the accepted ones.
"""

from __future__ import annotations

import re

from stockroom.functions.money import MONEY
from stockroom.operators import admission
from stockroom.schemas import CUSTOMER, ORDERS

_SCRIPT = """BEGIN
  DECLARE broken BIGINT DEFAULT 0;
  -- seq must be unique among the rows of a key, and not null
  SET broken = (SELECT count(*) FROM (
    SELECT {key}, seq FROM {batch} WHERE {key} IS NOT NULL
    GROUP BY {key}, seq HAVING count(*) > 1 OR seq IS NULL));
  IF broken > 0 THEN
    SELECT raise_error(broken || ' (key, seq) pair(s) repeat or have a null seq');
  END IF;

  -- the first row of each key is an aggregate, so a hot key shrinks before
  -- the shuffle; verdicts go back by (key, seq), which no two rows share
  CREATE TABLE {verdicts} USING parquet PARTITIONED BY (verdict){location} AS
  WITH first_rows AS (
    SELECT {key}, min(seq) AS seq, min_by({ref}, seq) AS ref, min_by({fits}, seq) AS fits
    FROM {batch} WHERE {key} IS NOT NULL GROUP BY {key}
  ), decided AS (
    SELECT f.{key}, f.seq,
           CASE WHEN e.{key} IS NOT NULL THEN '{exists}' WHEN r.ref IS NULL THEN '{unknown}'
                WHEN NOT f.fits THEN '{bad}' ELSE '{accepted}' END AS verdict
    FROM first_rows f
    LEFT JOIN (SELECT DISTINCT {key} FROM {existing}) e ON e.{key} = f.{key}
    LEFT JOIN (SELECT DISTINCT {reference_key} AS ref FROM {reference}) r ON r.ref = f.ref
  )
  SELECT b.*, coalesce(d.verdict, '{duplicate}') AS verdict
  FROM {batch} b LEFT JOIN decided d ON d.{key} = b.{key} AND d.seq = b.seq
  WHERE b.{key} IS NOT NULL
  UNION ALL
  SELECT b.*, '{null_key}' AS verdict FROM {batch} b WHERE b.{key} IS NULL;

  CREATE OR REPLACE TEMPORARY VIEW {after} AS
  SELECT {columns} FROM {existing}
  UNION ALL
  SELECT {columns} FROM {verdicts} WHERE verdict = '{accepted}';
END
"""

_RULES = {
    "add_customers": dict(columns=", ".join(CUSTOMER.fieldNames()), key="c_custkey", ref="c_nationkey", fits="true", reference_key="n_nationkey",
                          unknown="unknown_nation", existing="customer", reference="nation",
                          batch="new_customers", verdicts="customer_verdicts", after="customers_after"),
    "accept_orders": dict(columns=", ".join(ORDERS.fieldNames()), key="o_orderkey", ref="o_custkey",
                          fits=f"o_totalprice IS NULL OR try_cast(o_totalprice AS {MONEY.simpleString()}) IS NOT NULL",
                          reference_key="c_custkey", unknown="unknown_customer", existing="orders",
                          reference="customer", batch="new_orders", verdicts="order_verdicts", after="orders_after"),
}
_NAMES = ("existing", "reference", "batch", "verdicts", "after")


def script(procedure: str, location: str | None = None, **names: str) -> str:
    """The SQL script of ``add_customers`` or ``accept_orders``.  ``names`` may
    replace the tables and views it reads (``existing``, ``reference``, ``batch``) and makes (``verdicts``,
    ``after``); ``location`` is the folder of the verdict table."""
    if procedure not in _RULES:
        raise ValueError(f"unknown script {procedure!r}; known: {sorted(_RULES)}")
    for k, v in names.items():
        if k not in _NAMES or not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){0,2}", v):
            raise ValueError(f"{k}={v!r}: not a name of a table that the script uses")
    if location is not None and "'" in location:
        raise ValueError("a quote in the location")
    return _SCRIPT.format(**{**_RULES[procedure], **names}, location=f" LOCATION '{location}'" if location else "",
                          exists=admission.EXISTS, bad=admission.BAD_VALUE, accepted=admission.ACCEPTED,
                          duplicate=admission.DUPLICATE, null_key=admission.NULL_KEY)
