from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cadence.session import build_session

    # Tests own their session, so they set the checkpoint folder themselves.
    ckpt = tempfile.mkdtemp(prefix="cadence-test-ckpt-")
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def warehouse(spark, tmp_path):
    from cadence.sources.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "wh"))


def staged_df(spark, rows):
    """Staged plays from (title, artist, played_at, duration, artist_nk, song_nk) tuples."""
    from cadence.schemas import STAGED

    return spark.createDataFrame(rows, STAGED)
