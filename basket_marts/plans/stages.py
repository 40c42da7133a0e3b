"""Stages that leave a manifest, so that a run that failed goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from basket_marts.session import folder_exists


@dataclass(frozen=True)
class Stage:
    """A step of a batch: what it reads, what it writes, what its result depends on besides.

    `run` returns figures of the run, the rows of each output for instance.
    """

    name: str
    inputs: Sequence[str]
    outputs: Sequence[str]
    run: Callable[[], Mapping[str, int]]
    settings: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    stage: str
    inputs: str
    outputs: str
    figures: dict[str, int]


class StageLog:
    """Manifests of finished stages, one JSON file each below `root`.

    A stage counts as finished if its manifest says so, its inputs are the files they were (by
    path, size and time of change), and its outputs as well. The manifest is written last and
    moved into place whole: it is the commit mark.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def _fingerprint(self, paths: Sequence[str], settings: Mapping[str, object]) -> str:
        """Of all files below some paths; hidden ones, and marks of success, do not count."""
        digest = hashlib.sha256(json.dumps(dict(settings), sort_keys=True, default=str).encode())
        for path in paths:
            if not folder_exists(self.spark, path):
                digest.update(f"{path} is missing".encode())
                continue
            place = self._path(path)
            files = place.getFileSystem(self._conf)
            listed, found = files.listFiles(place, True), []
            while listed.hasNext():
                file = listed.next()
                if not file.getPath().getName().startswith((".", "_")):
                    found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
            digest.update(json.dumps(sorted(found)).encode())
        return digest.hexdigest()

    def _file(self, stage: str):
        return self._path(f"{self.root}/{stage}.json")

    def manifest(self, stage: str) -> Manifest | None:
        path = self._file(stage)
        if not path.getFileSystem(self._conf).exists(path):
            return None
        text = self.spark.read.text(path.toString(), wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def _commit(self, manifest: Manifest) -> None:
        path, staged = self._file(manifest.stage), self._path(f"{self.root}/.{uuid.uuid4().hex}")
        files = path.getFileSystem(self._conf)
        files.mkdirs(path.getParent())
        stream = files.create(staged, True)
        stream.write(json.dumps(manifest.__dict__).encode())
        stream.close()
        files.delete(path, False)
        if not files.rename(staged, path):
            raise OSError(f"cannot commit stage {manifest.stage}")

    def forget(self, stage: str) -> None:
        path = self._file(stage)
        path.getFileSystem(self._conf).delete(path, False)

    def is_finished(self, stage: Stage) -> bool:
        known = self.manifest(stage.name)
        return (
            known is not None
            and known.inputs == self._fingerprint(stage.inputs, stage.settings)
            and known.outputs == self._fingerprint(stage.outputs, {})
        )

    def run(self, stages: Sequence[Stage]) -> list[str]:
        """Run the stages in order, but for those that are finished; returns the names of those
        that ran. A stage that runs again writes its outputs anew, so whatever reads them runs
        again as well. A stage that fails leaves no manifest and stops the run.
        """
        ran = []
        for stage in stages:
            if self.is_finished(stage):
                continue
            self.forget(stage.name)
            inputs = self._fingerprint(stage.inputs, stage.settings)
            figures = {name: int(n) for name, n in stage.run().items()}
            self._commit(Manifest(stage.name, inputs, self._fingerprint(stage.outputs, {}), figures))
            ran.append(stage.name)
        return ran
