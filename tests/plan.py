"""Looking into plans."""


def executed_plan(df):
    """The final plan after adaptive execution."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def planned(df):
    """The plan before any stage has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """What ``explain("formatted")`` prints."""
    utils = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")
