"""Each query of the record-linkage operators against its SQL on the smallest tables."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
D = "/root/testdata/sf0.001"
from linkmill import queries as Q  # noqa: E402

from linkmill import queries_io, queries_parts  # noqa: E402, F401

NAMES = [*[n for n in Q.QUERIES if n in Q.SQL]]


def shown(v):
    return "null" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    if not Path(D).exists():
        pytest.skip("no tables here")
    c = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    df = Q.QUERIES[name](spark, D)
    r = c.execute(Q.SQL[name])
    names = [x[0] for x in r.description]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    want = sorted(tuple(shown(x[names.index(k)]) for k in cols) for x in r.fetchall())
    assert sorted(tuple(shown(x[k]) for k in cols) for x in df.collect()) == want
