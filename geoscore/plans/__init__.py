"""User-level jobs and the registered stand-in queries."""

from geoscore.plans.catalog import NOTES, ORACLES, QUERIES


def load_all():
    """Import every query module so their registrations run."""
    from geoscore.plans import learning, relational, spatial  # noqa: F401
    return QUERIES, ORACLES, NOTES
