"""DuckDB-runnable SQL twins of the registered operators (correctness oracle).

Each statement = the retail mapping CTEs (FIXTURES.md) + base views + the
question written independently in SQL with the fixture parameters inlined.
"""



def oracle_sql() -> dict[str, str]:
    from martlens.oracle import analytics, brief, quality
    out: dict[str, str] = {}
    for mod in (analytics, quality, brief):
        out.update(mod.SQL)
    return out
