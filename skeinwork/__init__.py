"""skeinwork: training-data preparation, scoring and retrieval as Spark DataFrame programs."""

__version__ = "0.1.0"
