"""Every registered query against its SQL statement on the smallest tables."""

from __future__ import annotations

import pytest
from compare import DATA, compare

from tidemart.workload import registry

ENTRIES = registry()


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_equals_sql(spark, duck, name):
    entry = ENTRIES[name]
    ok, note = compare(spark, duck, name, entry, entry.sql, f"{DATA}/sf0.001")
    assert ok, note


def test_every_query_has_sql():
    assert [n for n, e in ENTRIES.items() if e.sql is None] == []


def test_entry_runs(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).limit(1).count() == 1
