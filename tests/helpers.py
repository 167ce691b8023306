"""Reading plans and results in tests."""

import math


def rows(df, *order):
    """The rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()
    ]


def record(df):
    """The single row as a dict."""
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def plan(df):
    """The physical plan, details of every node included."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def close(a, b, tolerance=1e-9):
    return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
