"""A micro-batch is held as its jobs use it."""

from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from blockledger.streaming import ingest as ST
from ledger_blocks import block, tx, write_lines


def test_items_of_flagged_lines_are_read_once_a_batch(spark, tmp_dir, monkeypatch):
    """The read items, not the lines, are what a batch holds while it is written; every line counts."""
    read, held, real_read, real_write = [], [], ST.keep_readable_items, ST.M.write

    def reading(df):
        read.append(real_read(df))
        return read[-1]

    def writing(raw, store):
        held.append(read[-1].storageLevel.useMemory)
        return real_write(raw, store)

    monkeypatch.setattr(ST, "keep_readable_items", reading)
    monkeypatch.setattr(ST.M, "write", writing)
    good = [block(s, [tx(f"s{s}")]) for s in range(4)]
    landing = f"{tmp_dir}/held"
    write_lines(landing, good + ["{broken"])
    store = K.LedgerStore(namespace=fresh_namespace(spark, "held"), bucket_size=4)
    ST.continuous_ingest(spark, landing, store, f"{tmp_dir}/held-ckpt", available_now=True, hold_tip=False).awaitTermination()
    assert held and all(held)
    assert K.read_table(spark, store, "blocks").count() == 4
    assert spark.table(store.fqn(ST.LANDING_REJECTS)).count() == 1
