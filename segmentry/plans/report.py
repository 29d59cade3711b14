"""A text report of one segmentation, made of the small result tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

#: What the report lists of a metrics row, in groups.
MEASURES = {
    "scores": ["silhouette_estimate", "silhouette_error", "silhouette_score", "silhouette_sq", "davies_bouldin", "calinski_harabasz", "inertia"],
    "grades": ["silhouette_grade", "separation_grade"],
    "shape": ["n_clusters", "n_noise", "n_samples", "min_cluster_size", "avg_cluster_size", "max_cluster_size"],
}


def text_table(columns: list[str], rows: list[tuple]) -> list[str]:
    """Markdown lines; NULL is an empty cell."""

    def cell(v: Any) -> str:
        return "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)

    lines = [columns, ["---"] * len(columns), *[[cell(v) for v in row] for row in rows]]
    return ["| " + " | ".join(line) + " |" for line in lines]


def cluster_report(
    graded: dict[str, Any], sizes: DataFrame, profiles: DataFrame | None = None, run: dict[str, Any] | None = None
) -> str:
    """How the segments were found, one table per group of ``MEASURES``, and the segments themselves.

    Every input has at most one row per cluster.
    """
    lines = ["# Segments", "", *text_table(["setting", "value"], list((run or {}).items()))]
    for title, names in MEASURES.items():
        rows = [(n, graded[n]) for n in names if graded.get(n) is not None]
        lines += ["", f"## {title.capitalize()}", "", *text_table(["measure", "value"], rows)]
    rows = [(r["cluster"], r["cluster_size"], round(100.0 * r["share"], 1)) for r in sizes.orderBy("cluster").collect()]
    lines += ["", "## Segment by segment", "", *text_table(["segment", "customers", "percent"], rows)]
    if profiles is not None:
        rows = [tuple(r) for r in profiles.orderBy("cluster").collect()]
        lines += ["", "## Feature means", "", *text_table(profiles.columns, rows)]
    return "\n".join(lines) + "\n"
