"""icuflow: clinical event preparation and mortality modelling on Spark."""

__version__ = "0.1.0"
