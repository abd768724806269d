"""Report jobs: goal report (E6) and the reprocess maintenance step.
Each returns named DataFrames (the frames behind the reference's printed
tables and plots)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import missing_ratio, score_histogram, unique_vs_total
from tessera.operators.filters import to_score
from tessera.operators.topk import high_impact
from tessera.operators.windows import duplicate_rows, top_per_goal
from tessera.schemas import KEY, README_MISSING
from tessera.session import cut_lineage
from tessera.sources.catalogue import overwrite_and_verify, read_table


def goal_report(df: DataFrame, slugs: Sequence[str], k: int = 5, n: int = 10) -> dict[str, DataFrame]:
    """E6 = P13 -> A7, W1, A8 + T4."""
    score_cols = [f"{s}_score" for s in slugs]
    # Written once: three frames are read from it, and ``df`` may hold model calls.
    # The histogram and the top rows need no text but the summary.
    shown = [c for c in (*KEY, "created_at", "summary", "stars", "url") if c in df.columns]
    goals = [c for c in df.columns if c in {f"{s}_{x}" for s in slugs for x in ("score", "reason")}]
    scored = cut_lineage(to_score(df.select(*shown, *goals), score_cols))
    return {
        "histogram": score_histogram(scored, slugs),
        "top_per_goal": top_per_goal(scored, slugs, k),
        "high_impact": high_impact(scored, score_cols, n),
    }


def reprocess(spark: SparkSession, catalogue_path: str, col: str = "readme_snippet") -> dict:
    """E7 = A5, W2, A6 (audits), then P10 + S12: rewrite the catalogue
    without sentinel READMEs (nulls kept) and verify by reloading."""
    cat = read_table(spark, catalogue_path)
    audit = {
        "missing": missing_ratio(cat, col).first().asDict(),
        "duplicates": duplicate_rows(cat, KEY).count(),
        "unique_vs_total": unique_vs_total(cat, KEY).first().asDict(),
    }
    if audit["missing"]["missing"] == 0:
        audit["rewrite"] = None
        return audit
    reject = F.col(col).eqNullSafe(F.lit(README_MISSING))
    audit["rewrite"] = overwrite_and_verify(spark, catalogue_path, ~reject, reject)
    return audit
