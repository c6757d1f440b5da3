"""tabprep: tabular training-data preparation, resampling, synthesis and
model evaluation on Spark DataFrames.

Every operator is a lazy DataFrame transformation or a small aggregate whose
result (medians, category lists, class quotas, metric rows) is bounded by the
schema or the number of classes, never by the number of rows.
"""

from tabprep.spec import TabularSpec

__all__ = ["TabularSpec"]
