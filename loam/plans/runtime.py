"""A run of named stages with content-addressed reuse: a stage is read back if nothing it depends on has changed."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame], DataFrame]


@dataclass
class Run:
    """Stages write Parquet below folder, beside a manifest for each; folder may be in any store that Spark reaches."""

    spark: SparkSession
    folder: str
    stages: list[tuple[str, Stage, dict]] = field(default_factory=list)

    def add(self, name: str, stage: Stage, **params) -> Run:
        self.stages.append((name, stage, params))
        return self

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _manifest(self, name: str) -> dict:
        path = f"{self.folder}/{name}.manifest"
        fs, target = self._fs(path)
        return json.loads(self.spark.read.text(path).first()[0]) if fs.exists(target) else {}

    def execute(self, source: DataFrame, inventory: str, until: str | None = None, force_from: str | None = None) -> tuple[DataFrame, list[dict]]:
        """The last stage's rows and what each stage did; inventory names the input's content."""
        digest, rows, done, forced = hashlib.sha256(inventory.encode()).hexdigest(), source, [], False
        for name, stage, params in self.stages:
            digest = hashlib.sha256(json.dumps([digest, name, params], sort_keys=True).encode()).hexdigest()[:16]
            forced |= name == force_from
            path, began = f"{self.folder}/{name}.parquet", time.time()
            reused = not forced and self._manifest(name).get("digest") == digest
            if not reused:
                forced = True  # later stages depend on this one
                fs, target = self._fs(f"{self.folder}/{name}.manifest")
                fs.delete(target, True)
                stage(rows, **params).write.mode("overwrite").parquet(path)
                entry = json.dumps({"digest": digest, "seconds": round(time.time() - began, 3)})
                self.spark.createDataFrame([(entry,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}.manifest")
            rows = self.spark.read.parquet(path)
            done.append({"stage": name, "digest": digest, "reused": reused})
            if name == until:
                break
        return rows, done
