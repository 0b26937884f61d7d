"""Every query of the engine against its SQL; those that SQL can't express must give rows."""

import pytest
from compare import oracle, rows

from folioframe.registry import ORACLE_SQL, QUERIES

#: Results that may be empty or depend on chance, and need a run only.
RUN_ONLY = {"fuzzy_candidates", "fuzzy_review"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLE_SQL:
        assert rows(got) == rows(oracle(sf_dir, ORACLE_SQL[name]))
    elif name not in RUN_ONLY:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
