"""Registered exports on the given tables."""

from __future__ import annotations

from workloads import writes

SF = "/root/testdata/sf0.001"


def test_rows_of_a_task_do_not_grow_with_the_table(spark, monkeypatch):
    partitions = []

    def export(rows, path, **settings):
        partitions.append(rows.rdd.getNumPartitions())
        return real(rows, path, **settings)

    real = writes.export
    monkeypatch.setattr(writes, "export", export)
    monkeypatch.setattr(writes, "ROWS_PER_TASK", 1000)
    found = writes.QUERIES["export_row_groups"](spark, SF).first()
    n_rows = writes.load(spark, SF, "lineitem").count()
    assert tuple(found) == (n_rows, True, True) and partitions == [n_rows // 1000]
