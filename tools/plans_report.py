"""Write PLANS.md: physical-plan facts of the core operators, from explain().

Usage: python tools/plans_report.py [sf_dir]   (default sf0.01)
For each plan: shuffles, joins, whole-stage-codegen stages, Python nodes,
and the scan's ReadSchema / PushedFilters / PartitionFilters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blockledger import registry as REG  # noqa: E402
from blockledger.operators import blocktime as R  # noqa: E402
from blockledger.operators import flatten as P  # noqa: E402
from blockledger.operators import progress as G  # noqa: E402
from blockledger.plans import sink as K  # noqa: E402
from blockledger.session import build_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def facts(text: str) -> list[str]:
    out = []
    ex = re.findall(r"Exchange \(\d+\)|BroadcastExchange \(\d+\)", text)
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                  r"BroadcastNestedLoopJoin|CartesianProduct)", text)))
    jt = sorted(set(re.findall(r"Join type: (\w+)", text)))
    out.append(f"shuffles: {len([e for e in ex if e.startswith('Exchange')])}, "
               f"broadcasts: {len([e for e in ex if e.startswith('Broadcast')])}, "
               f"joins: {', '.join(joins) or 'none'} {('(' + ', '.join(jt) + ')') if jt else ''}")
    out.append(f"codegen stages: {len(set(re.findall(r'codegen id : (\d+)', text)))}, "
               f"python: {'yes' if re.search('EvalPython|FlatMapGroupsInPandas|MapInPandas', text) else 'no'}, "
               f"windows: {text.count('Window (')}, generate: "
               f"{', '.join(sorted(set(re.findall(r'Arguments: (explode|posexplode|inline|stack)', text)))) or 'none'}")
    for key in ("ReadSchema", "PushedFilters", "PartitionFilters"):
        for line in text.splitlines():
            if line.startswith(key + ":") and line.strip() != f"{key}: []":
                v = line.split(":", 1)[1].strip()
                out.append(f"{key}: `{v[:400]}{'...' if len(v) > 400 else ''}`")
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    raw = REG.raw_of(spark, sf)
    tip = G.chain_tip(raw).first()[0]
    store = K.LedgerStore(namespace=REG.fresh_namespace(spark, "plans"), bucket_size=250)
    K.write_all(raw.where(f"slot < {tip // 2}"), store)
    target = K.read_table(spark, store, "transactions")
    plans = {
        "blocks (P1)": P.blocks(raw),
        "transactions (P2)": P.transactions(raw),
        "instructions (P13, one pass)": P.instructions(raw),
        "token_balances (P8)": P.token_balances(raw),
        "rewards (P16)": P.rewards(raw),
        "slot_range (F2) on the landing": P.blocks(raw.where(G.slot_range_filter(100, 200, tip))),
        "slot_range (F2) on a bucketed table": target.where(G.slot_range_filter(100, 200, tip, 250)),
        "first_blocks (T2)": P.blocks(raw).orderBy("slot").limit(10),
        "skip stored slots before a re-append (K2/K3)":
            K.skip_stored(raw, store, "transactions", K.batch_status(raw, store, 0, tip)["transactions"], 0, tip),
        "last processed, top bucket only (A1)":
            target.where(F.col("slot_bucket") == (tip // 2 - 1) // 250).agg(F.max("slot")),
        "skipped_slots (M5)": G.skipped_slots(P.blocks(raw)),
        "missing_by_table (R5)": G.missing_by_table(raw, {"transactions": target.drop("slot_bucket")}),
        "fill_block_time (R1)": R.fill_block_time(P.blocks(raw), 250),
        "batch stats aggregate": raw.agg(F.count_distinct("slot"), F.max(P.most_items(raw))),
    }
    lines = ["# Physical plans of the core operators",
             "",
             f"Generated by `tools/plans_report.py` from `explain(\"formatted\")` at `{sf}` "
             "(local[8], AQE on; AQE may still switch join strategies at run time).",
             ""]
    for name, df in plans.items():
        lines.append(f"## {name}")
        lines.append("")
        lines.extend(f"- {f}" for f in facts(formatted(df)))
        lines.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
