"""Write the final (post-AQE) physical plans of the main steps to docs/PLANS.md.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from landfall.operators import ods as O  # noqa: E402
from landfall.operators.split import clean_rows, reject_rows  # noqa: E402
from landfall.operators.validate import duplicate_side, validate  # noqa: E402
from landfall.plans import metadata as M  # noqa: E402
from landfall.plans import schema as SC  # noqa: E402
from landfall.session import local_session, scratch_path  # noqa: E402
from landfall.sources import fixtures as fx  # noqa: E402
from landfall.sources import landing as L  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    meta = fx.metadata_frames(spark)
    li = M.file_specs(meta, ["LINEITEM"])[0]
    orders = M.file_specs(meta, ["ORDERS"])[0]
    out = [f"# Physical plans (final adaptive plans, {os.path.basename(sf_dir)}, local[8])\n",
           "Generated by `python tools/plans.py`. Expression ids removed; long lines cut at 220 characters.\n"]

    def add(title, note, df):
        out.append(f"## {title}\n\n{note}\n\n```\n{final_plan(df)}\n```\n")

    landed = fx.landed_lineitem(spark, sf_dir)
    side = duplicate_side(landed, li.keys)
    add("Duplicate keys of lineitem (measured side)",
        f"Key columns only, partial count before the shuffle. Measured: {side.rows} rows, "
        f"{side.bytes} bytes -> broadcast={side.broadcast}.", side.df.select("*"))
    add("Validate lineitem, measured side broadcast",
        "All checks in one codegen stage on the scan side; the duplicate-key side comes from the cache.",
        validate(landed, li.rules, li.keys, duplicates=side))
    side.release()
    big = duplicate_side(landed, li.keys, limit=0)
    add("Validate lineitem, side above the limit (sort-merge join)",
        "Broadcast limit 0: the same plan with a shuffle join; AQE would split hot keys here.",
        validate(landed, li.rules, li.keys, duplicates=big))
    big.release()

    stg = clean_rows(validate(fx.landed_orders(spark, sf_dir), orders.rules, orders.keys), orders.columns) \
        .withColumn("load_dt", F.lit(fx.LOAD_DT))
    pk = clean_rows(validate(fx.landed_orders_pk(spark, sf_dir), orders.key_rules(), orders.keys), list(orders.keys))
    feed = O.delete_key_side(pk, orders.keys)
    path = scratch_path(spark, "plans-stg")
    stg.write.partitionBy("load_dt").orc(path)
    add("Stage -> ODS with hard deletes",
        "Staging read with a partition filter and pruned columns; distinct delete keys (measured) broadcast; "
        "casts in the same stage.",
        O.stage_to_ods(L.for_load_date(spark.read.orc(path), fx.LOAD_DT), SC.layer_schema(orders, "ods"),
                       orders.keys, None, "2022-09-12 01:00:00", feed))
    feed.release()

    v = validate(fx.landed_orders(spark, sf_dir), orders.rules, orders.keys)
    add("Reject rows before their write (REBALANCE)",
        "Rejects are sparse; the rebalance lets AQE coalesce them into advisory-size files.",
        reject_rows(v, orders.columns).hint("rebalance"))
    events = M.file_specs(meta, ["EVENTS"])[0]
    ev = clean_rows(validate(fx.landed_events(spark, sf_dir), events.rules, events.keys), events.columns) \
        .withColumn("load_dt", F.lit(fx.LOAD_DT))
    add("ODS by load key before its dynamic-partition write (REBALANCE by key)",
        "Rebalanced by the load-key column: a few files per key; AQE splits a key with a large share of rows.",
        O.stage_to_ods(ev, SC.layer_schema(events, "ods"), events.keys, None, "2022-09-12 01:00:00")
        .hint("rebalance", *events.load_keys))

    csv = scratch_path(spark, "plans-csv")
    fx.landed_orders(spark, sf_dir).write.option("header", True).partitionBy("load_dt").csv(csv)
    add("CSV landing read for one load date",
        "PartitionFilters on the load date; empty vs missing fields resolved with column expressions.",
        L.for_load_date(L.read_landing_csv(spark, csv, fx.ORDER_COLUMNS), fx.LOAD_DT))

    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
