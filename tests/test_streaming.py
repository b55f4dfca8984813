"""M3 continuous ingest and M8 metrics: stream in steps, lost checkpoint, stream = batch."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from blockledger import schemas as S
from blockledger.plans import backfill as M
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from blockledger.sources.landed import read_blocks
from blockledger.streaming import ingest as ST
from ledger_blocks import block, tx, write_lines


def _counts(spark, store):
    return {r.table_name: r.row_count for r in M.stored_counts(spark, store).collect()}


def _drain(spark, landing, store, ckpt, hold_tip=False):
    q = ST.continuous_ingest(spark, landing, store, ckpt, available_now=True,
                             max_files_per_trigger=1, hold_tip=hold_tip)
    q.awaitTermination()
    return q


def test_stream_in_two_steps_and_replay(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    store = K.LedgerStore(namespace=fresh_namespace(spark, "s"), bucket_size=4)
    write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(0, 5)])
    _drain(spark, landing, store, f"{tmp_dir}/ckpt")
    assert _counts(spark, store)["blocks"] == 5
    write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(5, 9)])
    write_lines(landing, [block(3, [tx("s3")])])          # a slot landed again
    _drain(spark, landing, store, f"{tmp_dir}/ckpt")
    got = _counts(spark, store)
    assert got == {"blocks": 9, "transactions": 9, "instructions": 18, "rewards": 9}
    # lost checkpoint: everything is replayed, nothing is added
    _drain(spark, landing, store, f"{tmp_dir}/ckpt-new")
    assert _counts(spark, store) == got
    # stream result equals a batch load of the same files
    batch = K.LedgerStore(namespace=fresh_namespace(spark, "b"), bucket_size=4)
    from blockledger.sources.landed import read_blocks
    K.write_all(read_blocks(spark, landing, fmt="json"), batch, persist=True)
    assert _counts(spark, batch) == got
    m = ST.batch_metrics(spark, store)
    assert set(m.columns) >= {"batch_id", "table_name", "input_rows", "duration_ms"}
    assert m.where("table_name = 'blocks'").count() >= 3


def test_continuous_trigger_follows_new_files(spark, tmp_dir):
    landing = f"{tmp_dir}/follow"
    store = K.LedgerStore(namespace=fresh_namespace(spark, "f"), bucket_size=4)
    write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(0, 3)])
    q = ST.continuous_ingest(spark, landing, store, f"{tmp_dir}/follow-ckpt",
                             processing_time="1 second", hold_tip=False)
    try:
        q.processAllAvailable()
        write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(3, 6)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert _counts(spark, store)["transactions"] == 6
    assert len(ST.progress_rows(q)) >= 2


def test_stream_logs_unreadable_lines(spark, tmp_dir):
    landing = f"{tmp_dir}/bad-lines"
    store = K.LedgerStore(namespace=fresh_namespace(spark, "bl"), bucket_size=4)
    write_lines(landing, [block(1, [tx("a")]), "{broken", block(2, [tx("b")])])
    _drain(spark, landing, store, f"{tmp_dir}/bad-ckpt")
    assert _counts(spark, store)["transactions"] == 2
    rej = spark.table(store.fqn(ST.LANDING_REJECTS)).collect()
    assert [r.record for r in rej] == ["{broken"]
    metrics = ST.batch_metrics(spark, store).count()
    _drain(spark, landing, store, f"{tmp_dir}/bad-ckpt-lost")      # replayed: neither is repeated
    assert spark.table(store.fqn(ST.LANDING_REJECTS)).count() == 1
    assert ST.batch_metrics(spark, store).count() == metrics


def test_stream_equals_batch_run(spark, tmp_dir):
    """The newest slot waits in both, and the staging folders are gone afterwards."""
    import glob
    from blockledger.session import shared_dir
    landing = f"{tmp_dir}/both"
    for lo in (0, 4):
        write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(lo, lo + 4)] + ["{broken"])
    a = K.LedgerStore(namespace=fresh_namespace(spark, "sa"), bucket_size=4)
    b = K.LedgerStore(namespace=fresh_namespace(spark, "sb"), bucket_size=4)
    _drain(spark, landing, a, f"{tmp_dir}/both-ckpt", hold_tip=True)
    for _ in range(2):
        M.run_landed(spark, landing, b, start="genesis")
    assert _counts(spark, a) == _counts(spark, b) == {"blocks": 7, "transactions": 7, "instructions": 14, "rewards": 7}
    assert [r.record for r in spark.table(b.fqn(M.LANDING_REJECTS)).collect()] == ["{broken"]
    left = glob.glob(f"{shared_dir(spark).removeprefix('file:')}/**/blockledger/*", recursive=True)
    assert not [p for p in left if p.split("/")[-1].startswith(("pending-", "converted-", "compact", "append-new"))
                and "test" not in p.split("/")[-1]]


def test_hold_tip_keeps_newest_slot_until_a_newer_lands(spark, tmp_dir):
    landing = f"{tmp_dir}/tip"
    store = K.LedgerStore(namespace=fresh_namespace(spark, "tip"), bucket_size=4)

    def slots():
        t = K.read_table(spark, store, "blocks")
        return sorted(r.slot for r in t.select("slot").collect())

    def drain(ckpt):
        q = ST.continuous_ingest(spark, landing, store, f"{tmp_dir}/{ckpt}",
                                 available_now=True)
        q.awaitTermination()

    write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(0, 5)])
    drain("tip-ckpt")
    assert slots() == [0, 1, 2, 3]                       # slot 4 is the tip: held
    write_lines(landing, [block(s, [tx(f"s{s}")]) for s in range(5, 8)])
    drain("tip-ckpt")
    assert slots() == list(range(0, 7))                  # 4 released, 7 held
    drain("tip-ckpt-lost")                               # replay everything
    assert slots() == list(range(0, 7))
    assert _counts(spark, store)["transactions"] == 7


@pytest.mark.parametrize("where", ["hold", "held", "write", "metrics", "retire"])
def test_a_crash_between_the_steps_loses_and_doubles_nothing(spark, tmp_dir, monkeypatch, where):
    """Batch 2 fails at each step in turn and is replayed; slots 9 to 12 are stored once, 13 is held."""
    store = K.LedgerStore(namespace=fresh_namespace(spark, f"crash_{where}"), bucket_size=4)
    K.ensure_tables(spark, store)

    landed = {n: write_lines(f"{tmp_dir}/crash-{n}", [block(s, [tx(f"s{s}")]) for s in slots])
              for n, slots in ((1, (9, 10)), (2, (11, 12)), (3, (13,)))}

    def batch(n):
        ST.process_batch(read_blocks(spark, landed[n], "json"), n, store)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    batch(1)
    at = {"hold": (ST, "_hold_tip"), "held": (K, "write_all"), "metrics": (ST, "_record_metrics"), "retire": (ST, "_retire_held")}
    with monkeypatch.context() as m:
        if where == "write":  # some tables are written, then the batch is lost
            plain = K._write_table
            m.setattr(K, "_write_table", lambda raw, st, t, *a: fail() if t == "rewards" else plain(raw, st, t, *a))
        else:
            m.setattr(*at[where], fail)
        with pytest.raises(RuntimeError):
            batch(2)
    batch(2)
    batch(3)
    for t in store.tables:
        rows = [r.slot for r in K.read_table(spark, store, t).select("slot").collect()]
        assert set(rows) == {9, 10, 11, 12} and len(rows) == {"instructions": 8}.get(t, 4)
    assert [(r.slot, r.batch_id) for r in spark.table(store.fqn(ST.PENDING_TABLE)).collect()] == [(13, 3)]
    assert ST.batch_metrics(spark, store).select("batch_id", "table_name").distinct().count() == ST.batch_metrics(spark, store).count() == 12


def test_a_bounded_stream_logs_unreadable_lines(spark, tmp_dir):
    landing = write_lines(f"{tmp_dir}/bounded", [block(s, [tx(f"s{s}")]) for s in range(6)] + ["{broken", '{"slot": "x"}'])
    store = K.LedgerStore(namespace=fresh_namespace(spark, "bounded"), bucket_size=4)
    q = ST.continuous_ingest(spark, landing, store, f"{tmp_dir}/bounded-ckpt", available_now=True, start_slot=1, end_slot=4)
    q.awaitTermination()
    assert sorted(r.slot for r in K.read_table(spark, store, "blocks").collect()) == [1, 2, 3]
    assert sorted(r.record for r in spark.table(store.fqn(ST.LANDING_REJECTS)).collect()) == ['{"slot": "x"}', "{broken"]


def test_a_clean_batch_logs_nothing(spark, tmp_dir, monkeypatch):
    """Flagged lines are counted, which parses all files of a batch at once; without one the log is left alone."""
    called, log = [], ST.M.log_rejected_lines
    monkeypatch.setattr(ST.M, "log_rejected_lines", lambda *a: called.append(a) or log(*a))
    store = K.LedgerStore(namespace=fresh_namespace(spark, "c"))
    K.ensure_tables(spark, store)
    schema = T.StructType(S.RAW_BLOCK.fields + [T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    read = spark.read.schema(schema).option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN)
    ST.process_batch(read.json(write_lines(f"{tmp_dir}/clean", [block(1), block(2)])), 0, store)
    assert not called
    ST.process_batch(read.json(write_lines(f"{tmp_dir}/torn", [block(3), "{torn"])), 1, store)
    assert len(called) == 1 and spark.table(store.fqn("_landing_rejected")).count() == 1
