"""Order-event analytics on Spark: decode, validate, route, store, audit, report."""

__version__ = "0.1.0"
