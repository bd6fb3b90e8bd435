"""The driver contract of __spark_entry__ (no Spark needed)."""

import re


def test_registry_contract():
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert all(callable(f) for f in qs.values())
    assert all(isinstance(v, str) and v.strip() for v in sqls.values())
    for name in qs:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
