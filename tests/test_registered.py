"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from tests.compare import connect, difference

# No order was updated on the loaded day at the smallest scale.
# Queries over documents are tested with their own subpackage.
queries = {n: q for n, q in all_queries().items() if n in oracle_sql()}

EMPTY_WHEN_SMALL = {"ingest_day_filter"}


@pytest.fixture(scope="module")
def duck(request):
    from tests.conftest import SF_DIR

    return connect(SF_DIR)


def test_every_query_has_its_sql():
    own = {n for n in all_queries() if n != "pipeline" and not n[2:3].isdigit()}
    assert own <= set(oracle_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", list(queries))
def test_query_gives_what_its_sql_gives(spark, duck, sf_dir, name):
    found = difference(spark, duck, queries[name], oracle_sql()[name], sf_dir)
    assert found in ("", "no rows to compare") if name in EMPTY_WHEN_SMALL else not found, found


def test_entry(spark):
    assert entry(spark).count() > 0
