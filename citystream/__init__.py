"""City sensor-feed analytics on Spark: DataFrame/SQL batch jobs and the
Structured Streaming forms of the same transformations."""

__version__ = "0.1.0"
