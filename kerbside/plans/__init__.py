"""Named queries over the test tables."""

from importlib import import_module

MODULES = (
    "booking_queries",
    "window_queries",
    "message_queries",
    "quality_queries",
    "stream_queries",
    "learning_queries",
)


def all_queries():
    """Every registered query, by name."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    from kerbside.plans.catalog import QUERIES

    return QUERIES
