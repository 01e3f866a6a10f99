"""The exploratory summaries as files: one table and one CSV export each."""

from __future__ import annotations

from civiclens.plans.catalog import QUERIES
from civiclens.plans.workspace import Workspace
from civiclens.sources.files import write_csv

SUMMARIES = {
    "summary_missing_values": "missing_values",
    "summary_duplicate_sr": "duplicate_keys",
    "summary_top_complaints": "top_complaint_types",
    "summary_complaints_per_month": "complaints_per_month",
    "summary_closure_stats": "closure_stats",
    "summary_closure_times": "closure_sample",
    "summary_complaints_by_zip": "complaints_by_zip",
    "summary_complaints_geo": "geo_point_sample",
}


def write_summaries(ws: Workspace, folder: str) -> list[str]:
    """Write every summary below the folder, replacing earlier ones; returns their names.

    Each summary is computed once: the CSV is written from the finished table.
    """
    for name, query in SUMMARIES.items():
        path = f"{folder}/tables/{name}"
        QUERIES[query](ws).write.mode("overwrite").parquet(path)
        write_csv(ws.spark.read.parquet(path), f"{folder}/csv/{name}")
    return list(SUMMARIES)
