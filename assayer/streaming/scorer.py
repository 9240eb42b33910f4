"""Scoring a stream with whatever model is current."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators.classifiers import score_rows
from assayer.sources.versions import ModelStore

SCORES = {"prediction": "int", "score": "double", "model_batch": "bigint"}


@dataclass
class Scorer:
    """A ``foreachBatch`` function that scores each micro-batch with the store's current model.

    The pointer is read once a batch, and a model is loaded only when it names another one. Rows are stamped with
    the batch that trained their model; before there is one, prediction, score and stamp are null. Results go to
    a folder per micro-batch, so a replayed batch overwrites its own rows.

    ``prepare`` turns a batch into rows with the model's ``features``; ``carry`` names the columns to keep.
    """

    store: ModelStore
    out: str
    prepare: Callable[[DataFrame], DataFrame]
    carry: Sequence[str]
    version: int | None = None
    model: Model | None = None
    loads: int = field(default=0)

    def follow(self) -> None:
        """Load the model that the pointer names, if it is not the one at hand."""
        kept = self.store.promoted()
        newest = kept[0] if kept else None
        if newest != self.version:
            self.model = self.store.load(newest)
            self.version = newest
            self.loads += 1

    def scored(self, batch: DataFrame) -> DataFrame:
        if self.model is None:
            return batch.select(*self.carry, *[F.lit(None).cast(t).alias(n) for n, t in SCORES.items()])
        rows = score_rows(self.model, self.prepare(batch), self.carry)
        return rows.withColumn("model_batch", F.lit(self.version).cast("bigint"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.follow()
        self.scored(batch).write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")
