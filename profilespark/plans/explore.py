"""The whole exploration of one labelled table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from profilespark.operators import eda
from profilespark.operators.quality import check_schema
from profilespark.session import materialize
from profilespark.spec import TableSpec


def _check(found: dict[str, int], columns: list[str], spec: TableSpec) -> None:
    gaps = [f"{c} ({found[f'gaps_{n}']})" for n, c in enumerate(columns) if found[f"gaps_{n}"]]
    problems = [f"missing values in {', '.join(gaps)}"] if gaps else []
    if found["foreign"]:
        problems.append(f"{found['foreign']} labels in {spec.target} beyond {list(spec.labels)}")
    if problems:
        raise ValueError("The table cannot be explored: " + "; ".join(problems))


def explore(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """Every exploratory table, all from one collapse of the data to profile cells.

    The table is read and shuffled once; what follows works on distinct
    (features, label) cells written to the shared folder. The same scan counts
    missing cells and foreign labels, which are an error that names their columns.
    """
    check_schema(df, spec)
    looked_at = [*spec.features, spec.target, *([spec.weight] if spec.weight else [])]
    foreign = F.col(spec.target).isNotNull() & ~F.col(spec.target).isin(*spec.labels)
    seen = Observation("explore")
    observed = df.observe(
        seen, F.count_if(foreign).alias("foreign"),
        *[F.count_if(eda.missing_cells(df, [c]) > 0).alias(f"gaps_{n}") for n, c in enumerate(looked_at)])
    collapsed, cell_spec = eda.profile_cells(observed, spec)
    cells = materialize(collapsed, "profile-cells")
    if cells.isEmpty():
        raise ValueError("The table cannot be explored: no rows")
    _check(seen.get, looked_at, spec)
    information = materialize(eda.mutual_information(cells, cell_spec), "mutual-information")
    ranked = eda.mi_rank(information, cell_spec)
    top = [r["feature"] for r in eda.top_features(ranked).collect()]  # at most 30 names
    top_spec = cell_spec.with_(features=tuple(top))
    matrix = materialize(eda.spearman_matrix(cells, top_spec), "spearman")
    distribution = eda.class_distribution(cells, cell_spec)
    return {
        "dataset_statistics": eda.dataset_statistics(cells, cell_spec),
        "conflict_statistics": eda.conflict_statistics(cells, cell_spec),
        "conflicting_profiles": eda.conflicting_profiles(cells, cell_spec),
        "mutual_information": ranked,
        "class_distribution": eda.distribution_pages(distribution, ranked),
        "spearman_matrix": matrix,
        "top_correlated_submatrix": eda.top_correlated_submatrix(matrix, top_spec),
        "strongest_correlations": eda.strongest_correlations(matrix, top_spec),
    }
