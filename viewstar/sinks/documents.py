"""Writing landed documents to a document store. Needs the store's Spark connector."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from viewstar.functions.documents import DOCUMENT, ERROR
from viewstar.schemas import EVENT_FIELDS


def stored_documents(landed: DataFrame) -> DataFrame:
    """``_id``, the event fields and the whole text of the documents to store.

    The fields stand at the top level, where ``sources.landing.document_store`` reads them;
    text that was no JSON stands under ``raw``, a document's own text under ``json``.
    """
    document = F.col("route") == DOCUMENT
    return landed.filter(F.col("route") != ERROR).select(
        "_id", *EVENT_FIELDS, F.when(document, F.col("text")).alias("json"),
        F.when(~document, F.col("text")).alias("raw"))


def store_options(uri: str, database: str, collection: str) -> dict[str, str]:
    """Options of the write: replace by ``_id``, so a repeated batch stores nothing twice."""
    return {"connection.uri": uri, "database": database, "collection": collection,
            "operationType": "replace", "idFieldList": "_id", "upsertDocument": "true",
            "ignoreNullValues": "true"}


def to_document_store(uri: str, database: str, collection: str
                      ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over landing rows."""
    options = store_options(uri, database, collection)

    def send(batch: DataFrame, _batch_id: int) -> None:
        stored_documents(batch).write.format("mongodb").options(**options).mode(
            "append").save()
    return send
