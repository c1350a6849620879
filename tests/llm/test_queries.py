"""The corpus queries against their meaning in SQL."""

import pytest

from opinara.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches(name, spark, sf):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None
