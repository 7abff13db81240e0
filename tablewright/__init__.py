"""tablewright: table quality, feature and regression analytics as Spark jobs."""

__version__ = "0.1.0"
