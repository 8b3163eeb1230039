"""Looking at physical plans."""


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
