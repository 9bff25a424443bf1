"""Column lineage over large corpora of SQL texts, computed as Spark jobs."""

from lineagrid.plans.pipeline import Lineage, build_report

__all__ = ["Lineage", "build_report"]
