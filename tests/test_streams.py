"""Streams with late rows: nothing is dropped, nothing is stored twice, also after a restart."""

import pytest

from terrace.plans.facts import FactStore
from terrace.streaming import streams
from tests.conftest import rows_of

DDL = "id long, ts timestamp, n int"


@pytest.fixture
def late_stream(spark, frame, tmp_path):
    """(send rows as one file, run what is there, stored rows)."""
    root = str(tmp_path)
    schema = frame(DDL).schema
    stores = [FactStore(spark, f"{root}/{n}", schema, "id", "ts", buckets=4) for n in ("kept", "late")]

    def send(*rows):
        spark.createDataFrame([(i, f"2024-01-{d:02} 00:00:00", n) for i, d, n in rows], "id long, ts string, n int").select(
            "id", "ts", "n").selectExpr("id", "cast(ts as timestamp) ts", "n").coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        arriving = streams.read_stream(spark, f"{root}/in", schema, files=1)
        streams.finish(streams.store_with_late(
            arriving, *stores, "ts", "2 days", f"{root}/progress", f"{root}/marks"), timeout=120)

    return send, run, lambda: [rows_of(s.rows(), "id", "n") for s in stores], stores


def test_rows_behind_the_watermark_are_kept_apart(late_stream):
    send, run, stored, _ = late_stream
    send((1, 1, 0), (2, 10, 0), (3, 2, 0))  # a batch is judged by the ones before it
    run()
    send((4, 8, 0), (5, 7, 0), (2, 10, 9), (1, 1, 9), (6, 20, 0))
    run()
    send((5, 7, 9), (7, 17, 0), (8, 18, 0), (4, 8, 9))
    run()
    assert stored() == [[(1, 0), (2, 0), (3, 0), (4, 0), (6, 0), (8, 0)], [(5, 0), (7, 0)]]
    run()
    assert stored() == [[(1, 0), (2, 0), (3, 0), (4, 0), (6, 0), (8, 0)], [(5, 0), (7, 0)]]


def test_a_batch_that_failed_half_way_is_run_again(late_stream, monkeypatch):
    send, run, stored, stores = late_stream
    send((1, 10, 0))
    run()
    send((2, 1, 0), (3, 11, 0))
    send((4, 1, 0), (3, 11, 9))
    whole = FactStore.add

    def lost(self, batch, load=None, newest_first=()):
        if self is stores[1]:
            raise RuntimeError("the driver is gone")
        return whole(self, batch, load, newest_first)
    monkeypatch.setattr(FactStore, "add", lost)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(FactStore, "add", whole)
    run()
    assert stored() == [[(1, 0), (3, 0)], [(2, 0), (4, 0)]]
