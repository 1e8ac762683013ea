"""starweave: dimensional (star-schema) ETL as composable Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns) and is built from
Spark SQL built-ins so Catalyst can prune, push down and code-generate the plan.
"""

__version__ = "0.1.0"
