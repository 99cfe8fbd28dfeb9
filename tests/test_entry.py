import re

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["src", "dst", "count"]
    assert 0 < len(rows) <= 10


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # corpus operators that SQL cannot express are tested by brute force with their subpackage
    free = {n for n in q if re.match(r"op\d+_", n) or n == "pipeline"}
    assert set(q) - free <= set(o)
