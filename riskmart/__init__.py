"""Credit-risk datamart and model-monitoring engine on PySpark DataFrames.

Every public function takes DataFrames and returns lazy DataFrames. All months
are processed together: ``snapshot_date`` is an ordinary column, never a loop.
"""
