"""Registered queries and their SQL twins over the given tables."""


def _load():
    from checks import bronze_silver, frontier, gold_serving, registry  # noqa: F401

    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
