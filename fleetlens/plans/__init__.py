"""Composed plans: the registered queries and their SQL counterparts."""


def load_catalog():
    """Import every query module and return the filled catalog."""
    from fleetlens.plans import (  # noqa: F401
        admission_queries,
        catalog,
        counter_queries,
        flagship,
        detection_queries,
        forecast_queries,
        read_queries,
        registry_queries,
        scaling_queries,
        stored_queries,
        stream_queries,
        summary_queries,
        trace_queries,
    )

    return catalog
