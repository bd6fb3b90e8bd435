"""Saving and loading of fitted Spark ML stages whose state is one or more tables.

Numbers and column names of such a stage are ``Params`` and go into its metadata, as for any
stage.  Its tables become Parquet folders next to them, written by Spark and never collected.
So a ``PipelineModel`` that holds the stage can be saved, and ``CrossValidator`` can tune its estimator.

A loaded stage reads its tables where they were saved: saving it over its own folder is an error.
"""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame


class TableStage(MLWritable, MLReadable):
    """Mixin of a model: ``_tables`` gives its state, ``_restore`` takes it back.

    The class must be constructible without arguments.
    """

    saved_at: str | None = None

    def _tables(self) -> dict[str, DataFrame | None]:
        return {}

    def _restore(self, tables: dict[str, DataFrame]) -> None:
        raise NotImplementedError

    def write(self) -> TableStageWriter:
        return TableStageWriter(self)

    @classmethod
    def read(cls) -> TableStageReader:
        return TableStageReader(cls)


class TableStageWriter(MLWriter):
    def __init__(self, stage: TableStage):
        super().__init__()
        self.stage = stage

    def save(self, path: str) -> None:
        at = self.stage.saved_at
        if at is not None and at.rstrip("/") == path.rstrip("/"):
            raise ValueError(f"the stage reads its tables from {path}; save it elsewhere")
        super().save(path)

    def saveImpl(self, path: str) -> None:
        tables = {name: t for name, t in self.stage._tables().items() if t is not None}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"tables": sorted(tables)})
        for name, t in tables.items():
            t.write.parquet(f"{path}/tables/{name}")


class TableStageReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.cls()
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        stage._restore({name: spark.read.parquet(f"{path}/tables/{name}") for name in meta["tables"]})
        stage.saved_at = path
        return stage
