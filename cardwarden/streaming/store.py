"""Transactions and predictions written together, once per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.schemas import STORED_PREDICTION, STORED_TRANSACTION
from cardwarden.sinks.versions import FAN, ROWS_PER_BUCKET, Version, VersionedTables

KEY = "transaction_id"


class PredictionStore(VersionedTables):
    """The transaction and the prediction table, one version of both at a time.

    Batch numbers start at 0 with every checkpoint, so a batch is known by its query's identity and
    its number; a replay after a crash adds nothing twice and shows nothing half-written.  Ids are
    looked up in the buckets they fall into, whatever the store's age.  Deleting transactions takes
    their predictions along.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_bucket: int = ROWS_PER_BUCKET, fan: int = FAN):
        super().__init__(spark, path, {"transactions": STORED_TRANSACTION, "predictions": STORED_PREDICTION}, KEY,
                         rows_per_bucket, fan)

    def transactions(self, version: Version | None = None, keys: DataFrame | None = None) -> DataFrame:
        return self.read("transactions", version, keys)

    def predictions(self, version: Version | None = None, keys: DataFrame | None = None) -> DataFrame:
        return self.read("predictions", version, keys)

    def is_committed(self, query: str, batch_id: int) -> bool:
        return self.written(query, batch_id)

    def commit(self, transactions: DataFrame, predictions: DataFrame, query: str, batch_id: int) -> None:
        self.change(lambda: self.append({"transactions": transactions, "predictions": predictions}, query, batch_id))
