"""Table exploration and data quality on Spark.

A :class:`~tablewright.plans.spec.GridSpec` describes what a reader of a table
wants to see; :mod:`tablewright.plans.compiler` turns it into one lazy
DataFrame.  A :class:`~tablewright.operators.rules.RecordRules` describes what
a good record looks like; :mod:`tablewright.operators.validate` turns it into
valid rows, rejected rows and a report.
"""

from tablewright.operators.rules import Field, RecordRules
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, DownloadSpec, GridSpec, SortKey

__all__ = [
    "ColumnSpec",
    "DownloadSpec",
    "Field",
    "Grid",
    "GridSpec",
    "RecordRules",
    "SortKey",
]
