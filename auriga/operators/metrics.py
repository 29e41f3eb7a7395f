"""Reusable metric definitions: named dimensions and measures over one source table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MetricView:
    """Measures are evaluated after grouping, so a ratio is a ratio of sums.

    Only measures and dimensions can be asked for; rows of the source cannot.
    """

    def __init__(self, source: DataFrame, dimensions: Mapping[str, Column], measures: Mapping[str, Column]):
        self.source = source
        self.dimensions = dict(dimensions)
        self.measures = dict(measures)

    def query(
        self, measures: Sequence[str], by: Sequence[str] = (), where: Column | str | None = None
    ) -> DataFrame:
        """Group by every named dimension; `where` filters source rows before grouping."""
        unknown = [m for m in measures if m not in self.measures] + [d for d in by if d not in self.dimensions]
        if unknown or not measures:
            raise ValueError(f"not in this metric view: {unknown or 'no measure asked for'}")
        rows = self.source if where is None else self.source.filter(where)
        return rows.groupBy(*[self.dimensions[d].alias(d) for d in by]).agg(
            *[self.measures[m].alias(m) for m in measures]
        )


def budget_metrics(base: DataFrame) -> MetricView:
    """Budget metrics over the budget-versus-actual table."""
    planned, spent = F.sum("valor_orcado"), F.sum("valor_realizado")
    gap = (spent - planned).cast("double")
    return MetricView(
        base,
        dimensions={
            "Mês": F.col("mes"),
            "Tipo": F.col("tipo"),
            "Grupo": F.col("grupo"),
            "Área": F.col("area"),
            "Centro": F.col("centro_nome"),
            "Conta": F.col("conta_nome"),
        },
        measures={
            "Orçado": planned.cast("decimal(28,2)"),
            "Realizado": spent.cast("decimal(28,2)"),
            "Variância": (spent - planned).cast("decimal(28,2)"),
            "Variância %": 100 * gap / F.nullif(planned.cast("double"), F.lit(0.0)),
        },
    )
