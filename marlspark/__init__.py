"""Plan, build and audit labelled dataset collections on Spark."""

__version__ = "0.1.0"
