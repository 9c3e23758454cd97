"""membra - longitudinal membership analytics on Spark."""


def _pickle_by_value() -> None:
    # Python functions of this package that run inside tasks (the snapshot
    # decode, the vocabulary automata) are shipped with their code, so
    # executors do not need the package installed or on their path.
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to import by name
        pass


_pickle_by_value()
