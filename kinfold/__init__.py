"""Identity resolution on Spark: link, cluster and merge records of the same person."""

from kinfold.config import Settings
from kinfold.plans.run import RunResult, run

__all__ = ["RunResult", "Settings", "run"]
