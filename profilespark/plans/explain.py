"""Global and local explanation of the frozen model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from profilespark.operators.importance import importance_rank, importance_topn
from profilespark.operators.models import fit
from profilespark.operators.shapley import contribution_table, explained_rows, explanation_summary
from profilespark.operators.splits import BACKGROUND_SIZE, background_sample
from profilespark.session import materialize
from profilespark.spec import TableSpec


def explain(dev: DataFrame, samples: DataFrame, spec: TableSpec, family: str, parameters: dict[str, object],
            importance_summary: DataFrame, background_size: int = BACKGROUND_SIZE, weighted: bool = True) -> dict[str, DataFrame]:
    """Refit on the development table, rank global importances, and explain any set of rows."""
    model = fit(family, parameters, dev, spec, weighted)
    background = materialize(background_sample(dev, spec.key, background_size), "background")
    conditions = materialize(model.conditions(), "leaf-conditions")
    explained = materialize(explained_rows(samples, background, conditions, spec, model.selected), "explained")
    ranked = importance_rank(importance_summary, family)
    return {
        "importance_rank": ranked,
        "importance_topn": importance_topn(ranked),
        "contributions": contribution_table(explained, spec),
        "summary": explanation_summary(explained, background, model.score, spec),
    }
