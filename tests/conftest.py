"""Shared fixtures: a local session, and a reader of hand-made blocks."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from blockledger.session import build_session
    ckpt = tempfile.mkdtemp(prefix="blockledger-test-ckpt-")
    s = build_session("local[4]", app="blockledger-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bl-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from blockledger.session import shared_dir
    d = f"{shared_dir(spark)}/t-{uuid.uuid4().hex[:8]}"
    os.makedirs(d, exist_ok=True)
    return d


@pytest.fixture()
def read_json(spark, tmp_dir):
    from blockledger.sources.landed import read_blocks
    from ledger_blocks import write_lines

    def _read(blocks):
        path = f"{tmp_dir}/landed-{uuid.uuid4().hex[:6]}"
        return read_blocks(spark, write_lines(path, blocks), fmt="json")
    return _read
