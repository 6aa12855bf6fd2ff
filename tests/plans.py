"""Looking into physical plans."""


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df):
    """The plan before run-time changes, for counting its exchanges."""
    text = physical(df)
    return text.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in text else text
