"""Write the physical plans of the registered queries to a markdown file.

    python -m stockroom.plans.report /root/testdata/sf0.1 PLANS.md

Automatic broadcast is switched off, so the plans show the shuffles a
cluster would run on tables too large to broadcast; explicit broadcasts
(behind size checks) stay.  Trigger queries are left out: their plans are
those of ``admit_landed`` inside ``foreachBatch``, shown at the end.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from stockroom.plans.queries import QUERIES
from stockroom.session import build_session


_PROBED = ("The batch was read once and written; `batch` and `first-rows` below are what was written. ")
NOTES = {
    "product_list": "One scan, no shuffle.",
    "product_page": "TakeOrderedAndProject: each task keeps its best 50, the driver merges "
                    "50 per task. Later pages add a keyset filter, never a full sort.",
    "upsert_products": "The batch was reduced to one row a key and written; its keys passed the size check, so "
                       "only they are broadcast. `part` is scanned twice (anti join: kept rows, null keys "
                       "among them; semi join with the batch key range pushed: touched rows) and never "
                       "shuffled. Above the check: one shuffled full outer join.",
    "add_customers": _PROBED + "Existing and reference keys are probed against broadcast first keys (range "
                     "filters in PushedFilters), then verdicts are joined back on (key, seq), which is unique "
                     "per row, so a hot key spreads over all partitions. No window.",
    "customers_after_add": "add_customers plus a union with the existing customers.",
    "get_orders": "Customer and date bounds pushed into the scan; one stage.",
    "accept_orders": "As add_customers. The reference (`customer`) is probed, not broadcast, "
                     "because it grows with the data.",
    "accept_orders_prices": "As accept_orders; the price check is a column of the first rows.",
    "customer_orders": "Inner join UNION ALL anti join instead of a left join, so AQE may split "
                       "a hot customer's partition. The anti side needs only distinct order "
                       "customer keys (partial aggregate).",
    "order_lines": "Two shuffled joins over lineitem-sized data. Store lineitem and orders in the salted "
                   "layout (sources/layout.py) to drop the first pair of exchanges.",
    "order_lines_salted": "lineitem and orders are bucketed by (order key, piece): no exchange between them.",
    "order_totals": "Two partial aggregates; their union keeps the hash partitioning, so the "
                    "merge adds no exchange.",
    "call_get_orders": "The LATERAL SQL table function is decorrelated into one equi-join.",
    "call_order_lines": "As call_get_orders, over every order.",
    "call_product_page": "Spark turns the limit on the rank into TakeOrderedAndProject below the window: each task keeps a page.",
    "keep_customers": "The committed table: a read of the folders that its manifest names.",
    "keep_orders": "As keep_customers; refused rows come from their own folders.",
    "keep_products": "As keep_customers.",
    "sql_add_customers": "The table that the SQL script stored.",
}


def plan_summary(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
    details = []
    for block in text.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and "Scan parquet" in lines[0]:
            info = {k: v for k, v in (ln.split(": ", 1) for ln in lines[1:] if ": " in ln)}
            details.append(f"{lines[0].strip()}  {info.get('Location', '').split('[')[-1].rstrip(']')}\n"
                           f"    PushedFilters: {info.get('PushedFilters', '[]')}\n"
                           f"    ReadSchema: {info.get('ReadSchema', '')}")
    return tree.rstrip() + "\n\n" + "\n".join(details)


def trigger_batch_section(spark, sf_dir: str) -> str:
    """The plan one trigger micro-batch runs: ``admit_landed`` over landed rows,
    whose place is the struct (time, file, row) from ``_metadata``.
    The orders file stands in for a landing; the base table is orders."""
    from pyspark.sql import functions as F

    from stockroom.operators.admission import admit_landed
    from stockroom.sources.tables import read_table
    from stockroom.streaming.triggers import LANDED, ORDER_RULES as R
    landed = read_table(spark, sf_dir, "orders").select(
        "*", F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.row_index").alias("row")).alias(LANDED))
    v = admit_landed(landed, key=R.key, landed=LANDED, existing=read_table(spark, sf_dir, "orders"),
                     existing_key=R.key, ref_col=R.ref_col, reference=read_table(spark, sf_dir, "customer"),
                     reference_key=R.reference_key, unknown=R.unknown, money_col=R.money_col)
    summary = plan_summary(v)
    return ("## trigger micro-batch (admit_landed over landed rows)\n\n"
            "What `foreachBatch` runs before writing `rows/batch_id=N`. The first rows of each key and "
            "file were written (`first-rows`) and passed the size check, so existing and reference keys "
            "are probed with broadcast batch keys. The window over a key holds one row a file.\n\n"
            f"{counts(summary)}\n\n```\n{summary}\n```\n")


def counts(summary: str) -> str:
    tree = summary.split("\n\n")[0]
    shuffles = len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange \(", tree))
    broadcasts, reused = len(re.findall(r"BroadcastExchange \(", tree)), len(re.findall(r"ReusedExchange \(", tree))
    return f"shuffle exchanges: {shuffles}, broadcasts: {broadcasts}, reused: {reused}"


def main(sf_dir: str, out: str) -> None:
    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    parts = ["# Physical plans\n",
             f"Generated by `python -m stockroom.plans.report` on `{sf_dir}` with automatic broadcast "
             "off (cluster-sized tables). Explicit broadcasts are the size-checked ones.\n"]
    for name, q in QUERIES.items():
        if name.startswith("trigger_"):
            continue
        summary = plan_summary(q(spark, sf_dir))
        parts.append(f"## {name}\n\n{NOTES.get(name, '')}\n\n{counts(summary)}\n\n```\n{summary}\n```\n")
    parts.append(trigger_batch_section(spark, sf_dir))
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1",
         sys.argv[2] if len(sys.argv) > 2 else "PLANS.md")
