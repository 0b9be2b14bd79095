"""Directory layout: bronze, silver and gold roots, vintages and run dates.

A root may be a local folder or any URI Hadoop knows (``s3a://``, ``gs://``);
readers and writers take the path as it is.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths of one environment."""

    root: str

    def bronze(self, source: str, year: int | None = None) -> str:
        tail = f"/year={year}" if year else ""
        return f"{self.root}/bronze/{source}{tail}"

    def silver(self, table: str, year: int | None = None) -> str:
        tail = f"/year={year}" if year else ""
        return f"{self.root}/silver/{table}{tail}"

    def gold(self, table: str, run_date: str) -> str:
        return f"{self.root}/gold/{table}/run_date={run_date}"

    def latest(self, table: str) -> str:
        return f"{self.root}/gold/{table}/latest"

    def report(self, kind: str, run_date: str) -> str:
        return f"{self.root}/gold/dq_reports/{kind}_{run_date}"

    def web(self) -> str:
        return f"{self.root}/web/v1"

    def web_run(self, run_date: str) -> str:
        return f"{self.web()}/runs/{run_date}"

    def landing(self, source: str, dataset: str) -> str:
        return f"{self.root}/bronze/source={source}/dataset={dataset}"
