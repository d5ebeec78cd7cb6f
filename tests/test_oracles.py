"""Every query with an oracle gives the oracle's rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare

BUILDS, SQLS = queries(), oracle_sql()


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(name, spark, sf_dir, duck):
    frame = BUILDS[name](spark, sf_dir).toPandas()
    assert compare(frame, duck, SQLS[name]) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "segment" in df.columns
