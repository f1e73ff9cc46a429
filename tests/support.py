"""What the tests share. Nothing is imported from a conftest, whose name is not unique."""


def rows(df, *columns):
    """All rows as sorted tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)


def explained(df):
    """The formatted physical plan."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
