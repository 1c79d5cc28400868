"""Review integration and recommendation as Spark jobs.

Every public function takes and returns DataFrames or Columns; nothing here runs outside Spark.
"""
