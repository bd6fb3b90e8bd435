"""Plan shape of every oracle-backed query: no row-at-a-time Python UDF, no
cartesian product, no nested-loop join."""

from sf_paths import SF_SMALL

BANNED = ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_banned_operators_in_any_sql_checked_query(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    offenders = {}
    for name in sorted(sqls):
        plan = qs[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in BANNED if b in plan]
        if hits:
            offenders[name] = hits
    assert offenders == {}
