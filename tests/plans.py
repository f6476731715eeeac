"""Plan texts for tests."""


def plan_of(df, mode="formatted"):
    """The plan text explain() prints."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
