"""rootloom: dictionary-text analytics as Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or
Column).  A lookup of one root is a request table with one row.
"""

__version__ = "0.1.0"
