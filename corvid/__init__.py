"""corvid — table analytics on Spark.

Web-log mining, reproducible sampling and splitting, feature pipelines,
GLM / tree / neural classifiers with cross-validated selection, and
matrix-factorisation recommendation, each written as a function from
DataFrames to DataFrames so Catalyst plans the whole job.
"""

__version__ = "0.1.0"
