"""Every registered query of the library against its SQL; those without SQL must give rows."""

import pytest
from oracle import duck, spark_rows

from glossmark import plans, registry  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, small, name):
    found = spark_rows(registry.queries()[name](spark, small))
    if name in registry.oracle_sql():
        assert found == duck(small, registry.oracle_sql()[name])
    else:
        assert found[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
