"""Queries that publish a view leave no name behind in the session."""

import __spark_entry__ as E
from conftest import SF001


def test_region_view_leaves_no_name(spark):
    names = lambda: {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = names()
    out = E.queries()["region_view"](spark, SF001)
    assert names() == before
    assert out.exceptAll(E.queries()["region_opportunity"](spark, SF001)).isEmpty() and out.count() > 0
