"""Every registered query against its SQL on the smallest data set."""

import check_oracles
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    result = check_oracles.compare(spark, con, FOLDER, name)
    assert result.startswith(("equal", "rows only")) and "TYPES" not in result, result


def test_entry(spark):
    assert entry.entry(spark).count() > 0
