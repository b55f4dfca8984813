"""Command line ingest run: ``python -m blockledger --source PATH --namespace NS``.

Batch (default): resolve the start, process up to the end or the tip, stop.
``--stream``: follow the landing folder with Structured Streaming.
Prints one JSON line describing the run.
"""

from __future__ import annotations

import argparse
import json
import sys

from . import schemas as S
from .operators import progress as G
from .plans import backfill as M
from .plans import sink as K
from .session import build_session, fresh_path
from .sources.landed import read_blocks
from .streaming import ingest as ST


def _slot_setting(v: str | None):
    if v is None or v.lower() in ("none", "null", ""):
        return None
    return int(v.replace("_", "")) if v.replace("_", "").isdigit() else v.lower()


def parse_args(argv):
    p = argparse.ArgumentParser(prog="blockledger")
    p.add_argument("--source", required=True, help="folder of landed blocks")
    p.add_argument("--format", default="json", choices=["json", "parquet"])
    p.add_argument("--namespace", required=True)
    p.add_argument("--catalog", default=None)
    p.add_argument("--table-format", default="parquet")
    p.add_argument("--tables", default=",".join(S.TABLE_NAMES))
    p.add_argument("--start", default="last_processed",
                   help="genesis | latest | last_processed | slot")
    p.add_argument("--end", default=None, help="slot | latest | null (no end)")
    p.add_argument("--bucket-size", type=int, default=K.DEFAULT_BUCKET_SIZE)
    p.add_argument("--by-date", action="store_true", help="partition the tables by block date too")
    p.add_argument("--one-publish", action="store_true", help="readers of plans.publish see a batch in all tables or in none")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--trigger", default="1 second")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--write-tip", action="store_true",
                   help="stream: write the newest slot at once instead of waiting for a newer one")
    return p.parse_args(argv)


def main(argv=None) -> dict:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    tables = tuple(t for t in a.tables.split(",") if t)
    unknown = set(tables) - set(S.TABLE_NAMES)
    if unknown:
        raise SystemExit(f"unknown tables: {sorted(unknown)}")
    start, end = G.parse_start(_slot_setting(a.start)), _slot_setting(a.end)
    spark = build_session(app="blockledger-ingest")
    store = K.LedgerStore(namespace=a.namespace, tables=tables, fmt=a.table_format,
                          bucket_size=a.bucket_size, catalog=a.catalog, by_date=a.by_date,
                          one_publish=a.one_publish)
    if not a.stream:
        out = M.run_landed(spark, a.source, store, a.format, start, end)
    else:
        raw = read_blocks(spark, a.source, a.format)
        start_slot = M.resolve_start(spark, start, raw, store)
        end_slot = G.parse_end(end, G.chain_tip(raw).first()["tip_slot"])
        ckpt = a.checkpoint or fresh_path(spark, "stream-checkpoint")  # under spark.checkpoint.dir
        q = ST.continuous_ingest(spark, a.source, store, ckpt, fmt=a.format,
                                 available_now=a.available_now, processing_time=a.trigger,
                                 start_slot=start_slot, end_slot=end_slot,
                                 hold_tip=not a.write_tip)
        q.awaitTermination()
        out = {"start_slot": start_slot, "end_slot": end_slot, "checkpoint": ckpt,
               "batches": len(q.recentProgress)}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
