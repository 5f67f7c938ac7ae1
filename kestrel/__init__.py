"""kestrel - a library of lazy PySpark DataFrame operators.

Text tokenising and counting, nested records, tabular filter/group/join/top-k,
re-indexing and sorted storage, blocked numeric arrays in long form, pair
reductions, keyed-table upserts, bad-row quarantine and tumbling-window
counters (batch and Structured Streaming).  Every function takes DataFrames
and returns a lazy DataFrame; Catalyst and AQE do the planning.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python UDFs built from
    them run on executors that do not have the package installed (on a real
    cluster, shipping it with ``--py-files`` works too)."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older pyspark without the hook
        pass


_ship_by_value()
