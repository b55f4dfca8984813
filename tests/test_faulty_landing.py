"""The input with refused rows is landed once, so jobs over it read only the leaves they need."""

from __future__ import annotations

from blockledger.operators import flatten as P
from blockledger.sources import ledger
from ledger_blocks import block, tx


def test_faulty_rows_are_landed_once_and_read_in_part(spark, read_json, monkeypatch):
    raw = read_json([block(s, [tx(f"a{s}"), tx(f"b{s}")]) for s in (1, 3, 4, 32, 35)])
    monkeypatch.setattr(ledger, "ledger_raw", lambda *a: raw)
    got = ledger.faulty_raw(spark, "made-here")
    assert sorted(map(str, got.collect())) == sorted(map(str, ledger.with_faults(raw).collect()))
    assert ledger.faulty_raw(spark, "made-here").inputFiles() == got.inputFiles()
    plan = P.BUILDERS["instructions"](got)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "post_balances" not in plan.split("ReadSchema")[1]
