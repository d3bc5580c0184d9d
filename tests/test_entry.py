import os

import __spark_entry__
import pytest
from glossmill import queries as core

DATA = "/root/testdata/sf0.001"


def test_contract():
    names = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(names) and set(core.queries()) <= set(names)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    norm = lambda rs: sorted(tuple("∅" if x is None else str(x) for x in r) for r in rs)
    for name, sql in core.oracle_sql().items():
        if name in ("lookup_counts", "format_health", "lookup_forms", "lookup_lines", "alias_quality", "audit_counts", "audit_severity"):
            continue  # made of others that are compared
        df = core.queries()[name](spark, DATA)
        got = c.execute(sql)
        at = [d[0] for d in got.description]
        want = norm(tuple(r[at.index(k)] for k in sorted(df.columns)) for r in got.fetchall())
        assert norm(tuple(r[k] for k in sorted(df.columns)) for r in df.collect()) == want, name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() >= 0
