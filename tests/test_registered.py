"""Every registered query against its oracle on the smallest test tables."""

import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import __spark_entry__ as e  # noqa: E402
from claimwright.checks.registry import ORACLES, QUERIES  # noqa: E402
from compare import TESTDATA, differences, duck  # noqa: E402

SF = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def found(spark):
    """Differences of every query, several at a time: on small tables planning takes the time."""
    con, queries, oracles = duck(SF), QUERIES, ORACLES

    def check(name):
        try:
            return differences(queries[name](spark, SF), con.cursor(), oracles[name])
        except Exception as error:  # noqa: BLE001  (reported by the query's own test)
            return [f"{type(error).__name__}: {error}"]

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(queries, pool.map(check, queries)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(found, name):
    assert found[name] == []


def test_flagship_query(spark):
    row = e.entry(spark).first()
    assert row.total_claims > 0 and 0 < row.denial_pct < 100


def test_names_are_operator_ids():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
    assert all(name[0] in "scvdbmgtqx" and name[1:3].isdigit() for name in QUERIES)
