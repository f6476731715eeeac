"""Joining the sources and shaping the joined rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.cells import quoted
from tableflow.spec import PipelineSpec, SourceSpec


def shaped(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """The joined rows, filtered, with derived columns, and of them the selected ones.

    Filter and derived columns see every column of the join, also those that ``select`` leaves out, if
    text and list are plain: relations and one column for each entry. Where the text goes on, with a union, say, or
    ``select`` itself decides about the rows (``distinct``, aggregates), the list is selected first; so it is
    where filter or derived columns name a column that only ``select`` makes. Any other fault is raised.
    """
    if not spec.select:
        return _filtered_and_derived(assemble(spark, spec.sources), spec)
    selected = assemble(spark, spec.sources, spec.select)
    if not (spec.where.strip() or spec.add_columns):
        return selected
    if not _is_projection(selected):
        return _filtered_and_derived(selected, spec)
    try:
        df = _filtered_and_derived(assemble(spark, spec.sources), spec)
        names = {name.lower() for name in selected.columns}
        more = [quoted(name) for name, _ in spec.add_columns if name.lower() not in names]
        return df.selectExpr(*spec.select, *dict.fromkeys(more))
    except AnalysisException as error:
        if _missing_name(error) not in names_of(selected):
            raise
    return _filtered_and_derived(selected, spec)


def _filtered_and_derived(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    if spec.where.strip():
        df = df.where(spec.where)
    return derive(df, spec.add_columns)


def _is_projection(df: DataFrame) -> bool:
    """Whether the analyzed query is one projection, and no set operation, aggregate, sort or limit on top."""
    return df._jdf.queryExecution().analyzed().nodeName() == "Project"


def names_of(df: DataFrame) -> list[str]:
    """Column names without case."""
    return [name.lower() for name in df.columns]


def _missing_name(error: AnalysisException) -> str | None:
    """The column an analysis did not find, without what it is qualified by; None for other faults."""
    if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
        return None
    parts = re.findall("`((?:[^`]|``)*)`", (error.getMessageParameters() or {}).get("objectName", ""))
    return parts[-1].replace("``", "`").lower() if parts else None


def _relations(sources: Sequence[SourceSpec]) -> str:
    """The join texts in ``index`` order."""
    text = " ".join(source.join for source in sorted(sources, key=lambda source: source.index))
    if not text.strip():
        raise ValueError("no source has a join text, so there is nothing to select from")
    return text


def assemble(
    spark: SparkSession, sources: Sequence[SourceSpec], select: Sequence[str] | None = None
) -> DataFrame:
    """One query over the registered sources: their join texts, in ``index`` order.

    The text goes to Spark SQL unchanged, so any join, subquery, lateral view or set operation
    Spark knows works, and Catalyst picks the join strategy from table sizes. A source with no
    join text is only used if another text names it.
    """
    return spark.sql(f"select {', '.join(select) if select else '*'} from {_relations(sources)}")


def derive(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Add columns in order; each may use the ones before it, and an existing name is replaced."""
    for name, expression in columns:
        df = df.withColumn(name, F.expr(expression))
    return df


def duplicate_names(df: DataFrame) -> list[str]:
    """Column names that occur more than once under the session's case rule."""
    names = df.columns if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else names_of(df)
    return sorted(name for name, times in Counter(names).items() if times > 1)
