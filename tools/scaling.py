"""Blocks/s and rows/s by number of cores (one Spark process per core count).

Usage: python tools/scaling.py [sf_dir] [cores ...]   (default sf0.1, 1 2 4 8)
Each process warms up on sf0.001, lands the ledger, then times the flatten of
transactions and instructions (noop sink) and a full four-table write.
"""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = r"""
import json, os, sys, time
sys.path.insert(0, ROOT)
from pyspark.sql import functions as F
from blockledger import registry as REG
from blockledger.operators import flatten as P, progress as G
from blockledger.plans import sink as K
from blockledger.session import build_session
from blockledger.sources import ledger
cores, sf = int(sys.argv[1]), sys.argv[2]
spark = build_session(f"local[{cores}]", shuffle_partitions=max(2, 2 * cores),
                      extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
for s in (warm, sf):
    raw = ledger.ledger_raw(spark, s)
    t = {}
    for name in ("transactions", "instructions"):
        t0 = time.time(); P.BUILDERS[name](raw).write.format("noop").mode("overwrite").save()
        t[name] = time.time() - t0
    t0 = time.time(); K.write_all(raw, REG._store(spark)); t["write_all"] = time.time() - t0
exp = G.expected_rows(raw).agg(*[F.sum(c).alias(c) for c in ("blocks", "transactions", "instructions")]).first()
print(json.dumps({"cores": cores,
                  "tx_rows_per_sec": round(exp["transactions"] / t["transactions"]),
                  "ins_rows_per_sec": round(exp["instructions"] / t["instructions"]),
                  "write_all_blocks_per_sec": round(exp["blocks"] / t["write_all"]),
                  "seconds": {k: round(v, 2) for k, v in t.items()}}))
""".replace("ROOT", repr(ROOT))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = [int(c) for c in sys.argv[2:]] or [1, 2, 4, 8]
    for c in cores:
        out = subprocess.run([sys.executable, "-c", CHILD, str(c), sf], capture_output=True,
                             text=True, timeout=1200)
        lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
        print(lines[-1] if lines else f"cores={c} failed: {out.stderr[-500:]}", flush=True)


if __name__ == "__main__":
    main()
