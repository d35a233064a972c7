"""DataFrame -> DataFrame operators."""

from tessera.operators import grouped, quantiles, ranking, relational, setops, streams  # noqa: F401
