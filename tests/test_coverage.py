"""Slot coverage: runs equal the scanned slots, however the slots arrive."""

from __future__ import annotations

import random

import pytest

from blockledger.operators import coverage as C
from blockledger.plans import coverage as V
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from ledger_blocks import block, tx


def islands(slots) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted(set(slots)):
        if out and s == out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_runs_and_gaps(spark, size):
    r = random.Random(size)
    want, rows = {}, []
    for t in ("a", "b", "c"):
        runs = [(lo, lo + r.choice([0, 1, 5, 23])) for lo in (r.randrange(300) for _ in range(25))]
        rows += [(t, lo, hi) for lo, hi in runs + runs[:3]]
        want[t] = islands(s for lo, hi in runs for s in range(lo, hi + 1))
    m = C.merged(spark.createDataFrame(rows, V.DDL).repartition(3), size)
    got = sorted(tuple(x) for x in m.collect())
    assert got == sorted((t, *run) for t, runs in want.items() for run in runs)
    holes = sorted(tuple(x) for x in C.gaps(m, size).collect())
    assert holes == sorted((t, a[1] + 1, b[0] - 1) for t, runs in want.items() for a, b in zip(runs, runs[1:]))


def test_slots_without_a_number_and_no_slots(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), ("a", 3), ("a", 4)], "table_name string, slot long")
    assert [tuple(x) for x in C.merged(C.runs_of(df), 2).collect()] == [("a", 3, 4)]
    none = C.merged(C.runs_of(df.limit(0)), 2)
    assert none.count() == 0 and C.gaps(none, 2).count() == 0


def test_index_equals_the_tables_after_batches_in_any_order(spark, read_json):
    store = K.LedgerStore(namespace=fresh_namespace(spark, "runs"), bucket_size=4)
    for slots in ((9, 10, 12), (0, 1, 2, 3, 4), (3, 4, 5), (12, 17), (9, 10, 12)):
        raw = read_json([block(s, [tx(f"s{s}")] if s % 4 else [], rewards=[]) for s in slots])
        K.write_all(raw, store)
        V.record(raw, store)

    def check():
        got = sorted(tuple(x) for x in V.coverage(spark, store).collect())
        want = [(t, *run) for t in store.tables for run in islands(x.slot for x in K.read_table(spark, store, t).select("slot").collect())]
        assert got == sorted(want)
        assert ("blocks", 6, 8) in {tuple(x) for x in V.missing(spark, store).collect()}

    check()
    assert V.last_processed(spark, store) is None  # no table row of rewards yet
    before = spark.table(store.fqn(V.INDEX)).count()
    V.compact(spark, store)
    check()
    assert spark.table(store.fqn(V.INDEX)).count() < before
    store.tables = ("blocks", "transactions")
    assert V.last_processed(spark, store) == 17
