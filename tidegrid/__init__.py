"""tidegrid: a Spark-native engine for per-interval measurement grids.

Ordered events become a dense grid of measurements; the grid gets
exponentially weighted and trailing-quantile features with explicit
availability masks; SQL, typed three-state predicates, runs, periods,
accounting and distributions query it.  Every operator takes its member keys,
time column and step as parameters, so a grid may be of seconds or hours, and
a member a symbol-day or anything else.
"""

from tidegrid.config import FeatureConfig, View
from tidegrid.grid import Grid

__all__ = ["FeatureConfig", "Grid", "View"]
