"""A versioned store of compiled models (A6, A7) for jobs that reload them (H3).

Every ``publish`` writes the tables to a folder of a new version and then, last, one
manifest row that names the version and the folders of its trees and centres (a
kind that isn't published anew keeps its folder). Readers resolve one version
through the manifest, so they never see half of a publish, and a version's
tables never change afterwards. Two writers of one version collide: the folder
may not exist yet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dtree_compile import DTModel
from ..operators.kmeans import KMModel
from .tables import read_dt_tables, read_km_tables, write_dt_tables, write_km_tables

MANIFEST = "version long, trees long, centres long"
CACHED = 4  # versions whose compiled forms a driver keeps


class ModelStore:
    """Versions of compiled trees and centres below ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._loaded: dict[int, tuple[DTModel | None, KMModel | None]] = {}

    def manifest(self) -> DataFrame:
        """All published versions: (version, trees, centres), the versions that hold their tables."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.base}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self) -> int | None:
        """The newest published version."""
        return self.manifest().agg(F.max("version")).first()[0]

    def publish(self, trees: DTModel | None = None, centres: KMModel | None = None) -> int:
        """Write a new version; returns its number."""
        last = self.manifest().orderBy(F.desc("version")).limit(1).collect()
        version = last[0].version + 1 if last else 1
        folder = f"{self.base}/versions/{version}"
        if trees is not None:
            write_dt_tables(trees, folder, mode="errorifexists")
        if centres is not None:
            write_km_tables(centres, folder, mode="errorifexists")
        old = last[0] if last else None
        row = (version, version if trees is not None else old and old.trees, version if centres is not None else old and old.centres)
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.base}/manifest")
        return version

    def load(self, version: int) -> tuple[DTModel | None, KMModel | None]:
        """The models of a version; their compiled forms are kept for the next batch that asks for it."""
        if version not in self._loaded:
            row = self.manifest().where(F.col("version") == version).first()
            if row is None:
                raise ValueError(f"version {version} is not published")
            trees = None if row.trees is None else read_dt_tables(self.spark, f"{self.base}/versions/{row.trees}")
            centres = None if row.centres is None else read_km_tables(self.spark, f"{self.base}/versions/{row.centres}")
            self._loaded[version] = trees, centres
            for old in sorted(self._loaded)[:-CACHED]:
                del self._loaded[old]
        return self._loaded[version]


def score_from_store(
    stream: DataFrame,
    store: ModelStore,
    score: Callable[[DataFrame, DTModel | None, KMModel | None], DataFrame],
    out_path: str,
    checkpoint: str,
    on_batch: Callable[[int], None] | None = None,
) -> None:
    """H3 for trees and centres: every micro-batch is scored by the one version that is current when it starts.

    Output goes to ``out_path/epoch=<id>`` with the column ``model_version``; a retried batch
    replaces its own folder whole, so no batch mixes two versions.
    """

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        version = store.current()
        if version is None:
            raise ValueError(f"no model published below {store.base}")
        out = score(batch, *store.load(version)).withColumn("model_version", F.lit(version).cast("long"))
        out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")
        if on_batch is not None:
            on_batch(epoch_id)

    q = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
