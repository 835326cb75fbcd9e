"""Input columns out of the way of an operator's own."""

from pyspark.sql import DataFrame


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns renamed by place, and the new name of each; no operator uses such names."""
    names = [f"_in{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))
