"""Ingest run semantics (start/end settings, tip lag) and the command line."""

from __future__ import annotations

import pytest

from blockledger.__main__ import main
from blockledger.operators import progress as G
from blockledger.plans import backfill as M
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from ledger_blocks import block, tx, write_lines


def _blocks(spark, store):
    return sorted(r.slot for r in K.read_table(spark, store, "blocks").select("slot").collect())


def test_run_settings(spark, read_json):
    raw = read_json([block(s, [tx(f"s{s}")]) for s in range(0, 12)])
    store = K.LedgerStore(namespace=fresh_namespace(spark, "r"), bucket_size=4)
    out = M.run(spark, raw, store, start=3, end=5)
    assert out["start_slot"] == 3 and _blocks(spark, store) == [3, 4, 5]
    out = M.run(spark, raw, store)                      # last_processed, no end
    assert out["start_slot"] == 6 and _blocks(spark, store) == list(range(3, 11))   # tip 11 waits
    out = M.run(spark, raw, store, start="latest")      # nothing until the tip moves
    assert out["start_slot"] == 11 and _blocks(spark, store) == list(range(3, 11))
    M.run(spark, raw, store, start="genesis", end="latest")
    assert _blocks(spark, store) == list(range(0, 11))
    with pytest.raises(ValueError):
        G.parse_end("genesis", 11)


def test_command_line_batch_and_stream(spark, tmp_dir):
    landing = write_lines(f"{tmp_dir}/cli", [block(s, [tx(f"s{s}")]) for s in range(0, 8)])
    ns = fresh_namespace(spark, "cli")
    out = main(["--source", landing, "--namespace", ns, "--tables", "blocks,transactions",
                "--start", "genesis", "--end", "3", "--bucket-size", "4"])
    assert out["end_slot"] == 3
    assert spark.table(f"{ns}.transactions").count() == 4
    out = main(["--source", landing, "--namespace", ns, "--tables", "blocks,transactions",
                "--stream", "--available-now", "--checkpoint", f"{tmp_dir}/cli-ckpt",
                "--bucket-size", "4"])
    assert out["start_slot"] == 4
    spark.catalog.refreshTable(f"{ns}.blocks")
    assert spark.table(f"{ns}.blocks").count() == 7      # the tip waits, as in a batch run
    main(["--source", landing, "--namespace", ns, "--tables", "blocks,transactions", "--start", "genesis",
          "--stream", "--available-now", "--write-tip", "--checkpoint", f"{tmp_dir}/cli-ckpt-2",
          "--bucket-size", "4"])
    spark.catalog.refreshTable(f"{ns}.blocks")
    assert spark.table(f"{ns}.blocks").count() == 8


def test_command_line_rejects_bad_settings(tmp_dir):
    with pytest.raises(SystemExit):
        main(["--source", tmp_dir, "--namespace", "x", "--tables", "blocks,votes"])
    with pytest.raises(ValueError):
        main(["--source", tmp_dir, "--namespace", "x", "--start", "tomorrow"])
    assert G.parse_end(None, 9) is None and G.parse_end("LATEST", 9) == 9 and G.parse_end(4, 9) == 4
