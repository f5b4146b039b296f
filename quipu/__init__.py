"""quipu: everyday table analysis as Spark jobs.

Every operation takes DataFrames (or Columns) and returns DataFrames (or
Columns), so plans stay declarative and run on however many executors there are.
"""

__version__ = "0.1.0"
