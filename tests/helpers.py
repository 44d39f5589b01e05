from __future__ import annotations


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """The plan adaptive execution ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
