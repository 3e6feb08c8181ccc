"""Several outputs as one commit: written aside, then made current by one switch.

    <out>/runs/<run>/<output>/...     the files of one run, written once
    <out>/_current                    one small file that names the current run

``mode("overwrite")`` deletes the earlier output before it writes the new one, so a
run that fails leaves neither; and readers can meet outputs of two runs.  Here a run
writes into a folder of its own, and only when all outputs are there is the small
file replaced, by a rename.  A run that fails before leaves the earlier state as it is,
and readers that follow the file see the outputs of one run together.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

CURRENT = "_current"


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, which knows every store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file aside and rename it over the old one: readers see either."""
    jvm = spark.sparkContext._jvm
    aside = f"{path}.{os.urandom(6).hex()}"
    fs, where = _files(spark, aside)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        where.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if where.toUri().getScheme() else \
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(where, jvm.org.apache.hadoop.fs.Path(path), options)


def current(spark: SparkSession, out: str) -> dict[str, str]:
    """Output name -> folder of the current run; empty before the first commit."""
    text = _read_text(spark, f"{out.rstrip('/')}/{CURRENT}")
    if text is None:
        return {}
    state = json.loads(text)
    return {n: f"{out.rstrip('/')}/runs/{state['run']}/{n}" for n in state["outputs"]}


def read_output(spark: SparkSession, out: str, name: str, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """One output of the current run (JSON lines unless ``read`` says otherwise)."""
    folders = current(spark, out)
    if name not in folders:
        raise ValueError(f"{out} has no committed output {name!r}")
    return (read or spark.read.json)(folders[name])


class Commit:
    """One run's outputs.  ``path`` gives each its folder; ``publish`` makes all of
    them current at once; leaving the block without it (a failure) deletes them."""

    def __init__(self, spark: SparkSession, out: str, keep: int = 2):
        """``keep``: how many runs stay, the current one included, so that readers of the
        one before can end."""
        if keep < 1:
            raise ValueError("the current run must be kept")
        self.spark, self.out, self.keep = spark, out.rstrip("/"), keep
        self.run = os.urandom(8).hex()
        self.outputs: list[str] = []
        self.published = False

    def path(self, name: str) -> str:
        self.outputs.append(name)
        return f"{self.out}/runs/{self.run}/{name}"

    def publish(self) -> None:
        text = _read_text(self.spark, f"{self.out}/{CURRENT}")
        earlier = [] if text is None else (lambda s: [s["run"], *s["earlier"]])(json.loads(text))
        state = {"run": self.run, "outputs": self.outputs, "earlier": earlier[:self.keep - 1]}
        _replace_text(self.spark, f"{self.out}/{CURRENT}", json.dumps(state))
        self.published = True
        self._delete(earlier[self.keep - 1:])

    def _delete(self, runs: Iterable[str]) -> None:
        for run in runs:
            fs, where = _files(self.spark, f"{self.out}/runs/{run}")
            fs.delete(where, True)

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, *_) -> None:
        if not self.published:
            self._delete([self.run])
