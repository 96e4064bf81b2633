"""Records to a document store, through the connector that is installed for it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def load_store(records: DataFrame, uri: str, lang: str, database: str = "NLP", connector: str = "mongodb") -> None:
    """Appends the records to the collection `<lang>wiki` of a database. The connector is a Spark data source (for
    example MongoDB's); without it this raises a RuntimeError before anything is read."""
    writer = records.write.format(connector).mode("append")
    options = {"connection.uri": uri, "database": database, "collection": f"{lang}wiki"}
    try:
        writer.options(**options).save()
    except Exception as e:
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find the data source" in str(e):
            raise RuntimeError(f"no Spark connector {connector!r} is installed") from e
        raise
