"""Numbered manifests: what a folder holds becomes visible in one step.

A writer puts its tables into a fresh sub-folder and then commits
``manifest-<number>.json``, written under a hidden name and renamed into place.
A manifest that can be seen is thus whole, and so is what it names; a writer
that dies before leaves the manifests before it as they were. The rename fails
if the number is taken, so of two writers of one number one is told.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"manifest-(\d{10})\.json")


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def listing(spark: SparkSession, root: str) -> list[str]:
    """Names of what lies in ``root``; empty if there is no such folder."""
    at, fs = _opened(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed manifests, ascending."""
    return sorted(int(m[1]) for m in map(_NAME.fullmatch, listing(spark, root)) if m)


def file_of(root: str, number: int) -> str:
    return f"{root}/manifest-{number:010d}.json"


def read(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The manifest of that number, or the last one; None if there is none."""
    if number is None:
        found = numbers(spark, root)
        if not found:
            return None
        number = found[-1]
    return json.loads(spark.read.text(file_of(root, number), wholetext=True).first()[0])


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make ``content`` the manifest ``number`` of ``root``."""
    jvm = spark._jvm
    hidden, fs = _opened(spark, f"{root}/.manifest-{uuid.uuid4().hex}")
    out = fs.create(hidden)
    out.write(bytearray(json.dumps({**content, "number": number}).encode()))
    out.close()
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(hidden, jvm.org.apache.hadoop.fs.Path(file_of(root, number)), plain)
