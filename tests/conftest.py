from __future__ import annotations

import datetime as dt

import pytest

from checks.compare import duck
from postlake.schemas import ANNOTATION, RAW_POST
from postlake.session import local_session

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_tiny():
    return duck(TINY)


def utc(*parts: int) -> dt.datetime:
    return dt.datetime(*parts, tzinfo=dt.timezone.utc)


@pytest.fixture
def make_raw(spark):
    """Raw posts from partial rows; what a row leaves out is null."""

    def make(*rows: dict):
        names = RAW_POST.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW_POST)

    return make


@pytest.fixture
def make_annotations(spark):
    def make(*rows: dict):
        names = ANNOTATION.fieldNames()
        schema = ANNOTATION.fromJson(ANNOTATION.jsonValue())
        schema.fields[0].nullable = True
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return make
