"""The two complete runs: the analytics report, and the churn workflow."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyline.operators.churn import churn_report
from tallyline.operators.metrics import compute_all
from tallyline.operators.quality import require_quality
from tallyline.sources.sinks import save_model, write_report, write_table

# Blocks that grow with the data are written as Parquet tables, not as report JSON.
TABLE_BLOCKS = ("customer_features",)


def run_analytics(tables: Mapping[str, DataFrame], out: str, fail_below: float | None = None) -> list[str]:
    """Compute every block and write `out/report/<block>` as JSON and the feature table as
    Parquet. With `fail_below` a lower quality score stops the run before anything is written."""
    blocks = compute_all(tables)
    if fail_below is not None:
        require_quality(blocks["quality_checks"], fail_below)
    base = out.rstrip("/")
    report = {n: df for n, df in blocks.items() if n not in (*TABLE_BLOCKS, "items_enriched")}
    write_report(report, f"{base}/report")
    for name in TABLE_BLOCKS:
        write_table(blocks[name], f"{base}/{name}")
    return [*report, *TABLE_BLOCKS]


def run_churn(tables: Mapping[str, DataFrame], out: str, obs: str, horizon: int = 183,
              rounds: int = 300) -> dict[str, object]:
    """Train, evaluate and score; write the model, the scores (gzip CSV) and the report."""
    result = churn_report(tables, obs, horizon, rounds=rounds)
    base, selection = out.rstrip("/"), result["selection"]
    save_model(selection.model, f"{base}/model")
    write_table(result["scores"], f"{base}/scores", "csv")
    spark = result["scores"].sparkSession
    write_report({"leaderboard": selection.leaderboard_frame(spark),
                  **{n: result[n] for n in ("metrics", "roc_curve", "decile_lift", "feature_importance", "risk_tiers",
                                          "run_facts")}},
                 f"{base}/report")
    return result
