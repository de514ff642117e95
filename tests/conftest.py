import pytest

from chatloom.runtime import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)
