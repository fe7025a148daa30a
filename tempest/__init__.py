"""tempest: a PySpark-native library for keyed sensor readings on batch tables and streams.

Every operator is a function from DataFrames to a DataFrame. Order-sensitive operators take an
explicit arrival sequence column (``seq``), because Spark has no arrival order of its own.
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Functions and stateful processors of this package travel to Python workers by value, so the
    workers need not import the package (no ``--py-files`` needed, any working directory)."""
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 — older cloudpickle: ship the package with --py-files instead
        pass


_pickle_by_value()
