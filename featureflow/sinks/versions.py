"""Versions of a model in a shared folder (SNK7, SRC9)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.models import load_model


class ModelVersions:
    """Published models of ``folder``, numbered from 1.

    A model is written aside under a name of its own. What makes it a version
    is its manifest, ``versions/<number>.json``, with its place and the digest
    of every file: it is created last and never replaced, so readers see all of a
    model or none, a publisher that dies leaves no version, and of two
    that take one number the later takes the next.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def manifest_path(self, version: int) -> str:
        return f"{self.folder}/versions/{version}.json"

    def digests(self, name: str) -> dict[str, str]:
        """SHA-256 of each file of a model by its path within; files are read and digested by tasks."""
        root = f"{self.folder}/models/{name}"
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        within = F.element_at(F.split("path", f"/models/{name}/"), -1)
        return {r[0]: r[1] for r in files.select(within, F.sha2("content", 256)).collect()}

    def manifest(self, version: int) -> dict | None:
        """The manifest, or None if there is none or it is not wholly written yet."""
        path = self.path(self.manifest_path(version))
        if not self.files.exists(path):
            return None
        stream = self.files.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def numbers(self) -> list[int]:
        """Numbers that are taken, in order."""
        folder = self.path(f"{self.folder}/versions")
        if not self.files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self.files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def latest(self) -> int | None:
        """The highest version that is wholly published."""
        return next((n for n in reversed(self.numbers()) if self.manifest(n)), None)

    def publish(self, model: PipelineModel) -> int:
        name = uuid.uuid4().hex
        model.save(f"{self.folder}/models/{name}")
        text = json.dumps({"model": name, "files": self.digests(name)}).encode()
        version = max(self.numbers(), default=0) + 1
        while not self._create(version, text):
            version += 1
        return version

    def _create(self, version: int, text: bytes) -> bool:
        path = self.path(self.manifest_path(version))
        try:
            stream = self.files.create(path, False)
        except Py4JJavaError:
            if self.files.exists(path):  # another publisher has the number
                return False
            raise
        stream.write(text)
        stream.close()
        return True

    def load(self, version: int | None = None) -> PipelineModel:
        """A version, by default the latest; an error if it is not published or its files have changed."""
        wanted = self.latest() if version is None else version
        manifest = None if wanted is None else self.manifest(wanted)
        if manifest is None:
            raise ValueError(f"no version {'at all' if wanted is None else wanted} in {self.folder}")
        found = self.digests(manifest["model"])
        if found != manifest["files"]:
            changed = sorted(k for k in {*found, *manifest["files"]} if found.get(k) != manifest["files"].get(k))
            raise ValueError(f"version {wanted} in {self.folder} has changed files: {changed}")
        return load_model(f"{self.folder}/models/{manifest['model']}")


class LatestModel:
    """``scorer`` for micro-batches that takes the newest version whenever a batch begins.

    ``score`` makes the output rows from a model and a batch; ``version`` is
    added to them. A version is loaded once.
    """

    def __init__(
        self,
        versions: ModelVersions,
        score: Callable[[PipelineModel, DataFrame], DataFrame],
        column: str = "version",
    ):
        self.versions, self.score, self.column = versions, score, column
        self.version: int | None = None
        self.model: PipelineModel | None = None

    def __call__(self, batch: DataFrame) -> DataFrame:
        latest = self.versions.latest()
        if latest != self.version or self.model is None:
            self.model, self.version = self.versions.load(latest), latest
        return self.score(self.model, batch).withColumn(self.column, F.lit(self.version))
