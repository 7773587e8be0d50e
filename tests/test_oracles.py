"""Every query agrees with its statement on the smallest tables."""

import __spark_entry__ as entry
import pytest
from oracle import differences

ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_oracle(spark, small, name):
    frame = entry.queries()[name](spark, small)
    assert differences(frame, entry.oracle_sql()[name], small) == ""


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, small, name):
    assert entry.queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
