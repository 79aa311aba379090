"""Every registered query equals its SQL on whole tables."""

import pytest

from checks.compare import differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), SF, ORACLE[name]) is None
