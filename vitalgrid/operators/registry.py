"""Versioned models in a shared folder.

A version is a folder with the fitted stages and everything its preprocessing needs. The version
record, written last, makes it visible: a reader never sees half a model.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from vitalgrid.operators.encoding import Dictionary, Preprocessor
from vitalgrid.streaming import files, logs


@dataclass
class Registry:
    spark: SparkSession
    folder: str
    #: Newest versions that are kept; older ones are removed when a new one is saved. None keeps all.
    keep: int | None = None

    def _version(self, version: int) -> str:
        return f"{self.folder}/models/v{version:08d}"

    def latest(self, before: int | None = None) -> int | None:
        """Newest complete version, of those below `before` if given."""
        return logs.newest_batch(self.spark, f"{self.folder}/versions", before)

    def save(
        self, version: int, stages: PipelineModel | None, preprocessor: Preprocessor | None = None, **facts
    ) -> int:
        """Writes the model first and its record last; saving a version again replaces it.

        A model that its facts describe in full has no stages.
        """
        folder = self._version(version)
        if stages is not None:
            stages.write().overwrite().save(f"{folder}/stages")
        meta = {"facts": facts, "preprocessor": None}
        if preprocessor is not None:
            meta["preprocessor"] = preprocessor.describe()
            if preprocessor.dictionary is not None and preprocessor.dictionary.entries is None:
                preprocessor.dictionary.table.write.mode("overwrite").parquet(f"{folder}/dictionary")
        record = self.spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1)
        logs.append_batch(record, f"{self.folder}/versions", version)
        if self.keep is not None:
            stored = [n for n in files.names(self.spark, f"{self.folder}/models") if int(n[1:]) <= version]
            for name in stored[:-self.keep]:
                files.remove(self.spark, f"{self.folder}/models/{name}")
        return version

    def facts(self, version: int) -> dict:
        return self._meta(version)["facts"]

    def _meta(self, version: int) -> dict:
        row = logs.read_batch(self.spark, f"{self.folder}/versions", version).first()
        return json.loads(row["meta"])

    def load(self, version: int) -> tuple[PipelineModel, Preprocessor | None]:
        folder = self._version(version)
        stages = PipelineModel.load(f"{folder}/stages")
        described = self._meta(version)["preprocessor"]
        if described is None:
            return stages, None
        preprocessor = Preprocessor.from_description(described)
        if preprocessor.categories and preprocessor.dictionary is None:
            preprocessor.dictionary = Dictionary(None, self.spark.read.parquet(f"{folder}/dictionary"))
        return stages, preprocessor
