"""Hand-over to a search index through its own Spark connector, if present."""

from __future__ import annotations

from pyspark.sql import DataFrame


def index_options(resource: str, nodes: str, key: str | None = "event_id",
                  upsert: bool = True) -> dict[str, str]:
    """Connector options: target, nodes, and for an upsert the document id."""
    # Setting names of the connector.
    options = {"es.nodes": nodes, "es.resource": resource, "es.index.auto.create": "true"}
    if upsert and key is None:
        raise ValueError("an upsert needs a key")
    if key is not None:
        options["es.mapping.id"] = key
    if upsert:
        options["es.write.operation"] = "upsert"
    return options


def write_index(df: DataFrame, options: dict[str, str], fmt: str = "es") -> None:
    """Write ``df`` with the connector registered as ``fmt``."""
    df.write.format(fmt).mode("append").options(**options).save()
