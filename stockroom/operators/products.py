"""O2 product list / page and O3 product upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.plans.joins import probe_limit
from stockroom.session import materialise

KEY = "p_partkey"
ATTRS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
COLUMNS = [KEY] + ATTRS


def product_list(part: DataFrame) -> DataFrame:
    """All products with their six columns."""
    return part.select(*COLUMNS)


def product_page(part: DataFrame, size: int = 50, after: tuple | None = None) -> DataFrame:
    """First ``size`` products by ``(p_name, p_partkey)``.

    ``p_name`` repeats, so the key breaks ties and pages are stable.  The
    next page is asked for with ``after=(last p_name, last p_partkey)``: a
    filter plus top-k, so a deep page costs the same as the first and never
    sorts the whole table (plans to TakeOrderedAndProject).
    """
    df = part.select(*COLUMNS)
    if after is not None:
        name, key = after
        nm, k = F.col("p_name"), F.col(KEY)
        if name is None:          # nulls sort last: only later null names remain
            df = df.filter(nm.isNull() & (k > F.lit(key)))
        else:
            df = df.filter((nm > F.lit(name)) | ((nm == F.lit(name)) & (k > F.lit(key)))
                           | nm.isNull())
    return df.orderBy(F.col("p_name").asc_nulls_last(), F.col(KEY).asc_nulls_last()).limit(size)


# action values of upsert_products
INSERTED, UPDATED, UNCHANGED, KEPT, REJECTED = "inserted", "updated", "unchanged", "kept", "rejected"


def upsert_products(current: DataFrame, batch: DataFrame, seq: str | None = None,
                    probe_max_rows: int | None = None, scratch: str | None = None) -> DataFrame:
    """Keep the product list: merge ``batch`` into ``current``, batch wins.

    One row per key in the result, with ``action``:
    inserted (key only in batch), updated (in both, some attribute differs,
    nulls compared as values), unchanged (in both, all equal), kept (only in
    current).  Batch rows without a key cannot be merged and come back as
    ``rejected``; current rows without a key stay as ``kept``.

    If ``seq`` is given the batch may repeat a key and its highest ``seq``
    wins; that reduction is a partial (map-side) aggregate, so a key that
    repeats in a third of the batch does not land whole on one task.
    Without ``seq`` the batch keys must be unique; a batch that repeats one
    is refused with ``ValueError`` (a partial aggregate checks it).

    Plan: the batch, reduced to one row a key, is written once (to ``scratch``
    if given); size, key range and the joins read that.  When the batch keys
    pass a size check, only they are broadcast and ``current`` (the big side) is scanned twice without a shuffle: an
    anti join gives the kept rows, a semi join (its scan pruned to the
    batch's key range) the current rows the batch touches.  Those are at
    most as many as the batch, so meeting them with the batch is a
    batch-sized join.  Above the bound it is one shuffled full outer join.

    The result is a new table: write it to a new directory, never over the
    one ``current`` is read from.
    """
    reduced = (batch.filter(F.col(KEY).isNotNull()).groupBy(KEY)
               .agg(F.max(F.struct(*([F.col(seq).alias("_seq")] if seq else []), *ATTRS)).alias("_row"),
                    F.count(F.lit(1)).alias("_n"))
               .select(KEY, *[F.col(f"_row.{c}").alias(c) for c in ATTRS], "_n"))
    # a null seq sorts lowest in the maximum, so a key whose rows all lack a
    # seq still keeps one of its rows
    kept_rows = materialise(reduced.unionByName(
        batch.filter(F.col(KEY).isNull()).select(*COLUMNS, F.lit(1).cast("bigint").alias("_n"))), "products", scratch)
    new = kept_rows.filter(F.col(KEY).isNotNull())
    new_null = kept_rows.filter(F.col(KEY).isNull()).select(*COLUMNS).withColumn("action", F.lit(REJECTED))
    # Size, key range and repeats from one scan of what was written.
    st = new.agg(F.count(F.lit(1)).alias("n"), F.min(KEY).alias("k0"), F.max(KEY).alias("k1"),
                 F.count_if(F.col("_n") > 1).alias("repeats")).first()
    if seq is None and st["repeats"]:
        raise ValueError(f"{st['repeats']} key(s) repeat in the batch; give seq to choose among their rows")
    new = new.select(KEY, *[F.col(c).alias(f"_new_{c}") for c in ATTRS], F.lit(True).alias("_in_new"))
    cur = current.select(KEY, *[F.col(c).alias(f"_cur_{c}") for c in ATTRS], F.lit(True).alias("_in_cur"))

    nothing_new = [*[F.lit(None).alias(f"_new_{c}") for c in ATTRS], F.lit(None).cast("boolean").alias("_in_new")]
    if st["n"] <= probe_limit(batch.sparkSession, probe_max_rows):
        # a null key matches nothing, so the anti join keeps those rows too
        keys = F.broadcast(new.select(KEY))
        kept = cur.join(keys, KEY, "left_anti").select("*", *nothing_new)
        hit = (cur.filter(F.col(KEY).between(F.lit(st["k0"]), F.lit(st["k1"])))
                  .join(keys, KEY, "left_semi"))
        merged = kept.unionByName(new.join(hit, KEY, "left"))
    else:
        # null keys apart: a shuffle would send them all to one task
        merged = cur.filter(F.col(KEY).isNotNull()).join(new, KEY, "full_outer").unionByName(
            cur.filter(F.col(KEY).isNull()).select("*", *nothing_new))

    same: Column = F.lit(True)
    for c in ATTRS:
        same = same & F.col(f"_cur_{c}").eqNullSafe(F.col(f"_new_{c}"))
    in_new, in_cur = F.col("_in_new").isNotNull(), F.col("_in_cur").isNotNull()
    action = (F.when(~in_cur, F.lit(INSERTED))
               .when(~in_new, F.lit(KEPT))
               .when(same, F.lit(UNCHANGED))
               .otherwise(F.lit(UPDATED)))
    out = merged.select(
        KEY,
        *[F.when(in_new, F.col(f"_new_{c}")).otherwise(F.col(f"_cur_{c}")).alias(c) for c in ATTRS],
        action.alias("action"))
    return out.unionByName(new_null)
