"""Small helpers for the tests."""


def rows(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, list)
                                      else (True, "list", str(v)) for v in r))


def plan(df):
    """The physical plan as text, before adaptive execution changes it."""
    return df._jdf.queryExecution().executedPlan().toString()
