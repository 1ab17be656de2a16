"""Weekly drift and quality run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_CURRENT_ROWS, REFERENCE_ROWS
from ..functions.features import build_features
from ..operators.aggregates import mean_score
from ..operators.drift import drift_metrics, feature_drift
from ..operators.filters import has_min_rows
from ..operators.quality import quality_summary
from ..operators.split import reference_sample
from ..operators.trees import TreeModel, score_trees
from ..session import store
from ..sources.readers import read_papers_window
from ..sources.writers import append_metrics, write_drift_report


def monitor(seed_papers: DataFrame, papers: DataFrame, as_of: str, report_path: str,
            metrics_path: str, model: TreeModel | None = None, days: int = 30,
            reference_rows: int = REFERENCE_ROWS, min_rows: int = MIN_CURRENT_ROWS,
            family: str = "distance") -> bool:
    """Compare the recent window with a sample of the training papers; append report and metrics.

    Returns whether a report was made: a window with too few papers has none. ``family`` names the
    drift methods: distances suit the reference sample of thousands of rows, p-values small ones.
    """
    current = read_papers_window(papers, as_of, days)
    if not has_min_rows(current, min_rows):
        return False
    # Texts are read once: everything below works on the stored 27 columns.
    matrix = store(build_features(current, ("arxiv_id",)), "current")
    reference = build_features(reference_sample(seed_papers, reference_rows))
    drift = store(feature_drift(reference, matrix, family), "drift")
    profile = quality_summary(matrix)
    # Both have one row per feature.
    write_drift_report(profile.join(F.broadcast(drift), "feature", "left"), report_path, as_of[:10])
    size = matrix.agg(F.count("*").alias("papers"))
    mean = mean_score(score_trees(matrix, model)) if model else None
    append_metrics(drift_metrics(drift, size, as_of, mean), metrics_path)
    return True
