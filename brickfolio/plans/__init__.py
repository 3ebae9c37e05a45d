"""Query plans: the pipeline, the benchmark mapping, and the query catalog."""


def load_catalog():
    """All registered queries and oracle statements."""
    from brickfolio.plans import catalog, queries_price, queries_identity, queries_data, queries_models, queries_landing, queries_stored, queries_contracts  # noqa: F401

    return catalog.QUERIES, catalog.ORACLES
