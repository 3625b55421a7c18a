"""Every registered query against its SQL counterpart."""

import pytest

from millrace.plans import load_all
from tests.oracle import compare

QUERIES = sorted(load_all().items())


@pytest.mark.parametrize("name", [n for n, _ in QUERIES])
def test_query(name, spark, con, sf):
    fn, sql = dict(QUERIES)[name]
    if sql is None:
        assert fn(spark, sf).count() > 0
    else:
        assert compare(spark, con, fn, sql, sf) == []
