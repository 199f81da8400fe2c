"""Published versions of tables: one small file per version names the parts that belong to it.

A version exists once its file does, and the file appears whole, by a rename. Publishing a version
again adds a file with the next number, which counts from then on; nothing is deleted for it, so a
published version is there at every moment. Several tables may share a log, so that they advance
together. Older versions can be removed with their data.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: By table path: bucket to the version that holds its rows, or None where the bucket is empty.
Tables = dict[str, dict[int, int | None]]


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, place = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.delete(place, True)


def folder(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.mkdirs(place)


def put(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another. One without files only takes the other away."""
    fs, place = _open(spark, source)
    remove(spark, target)
    if not names(spark, source):
        fs.delete(place, True)
    elif not fs.rename(place, _open(spark, target)[1]):
        raise OSError(f"{source} could not be put in the place of {target}")


def _published(spark: SparkSession, log: str) -> dict[int, list[str]]:
    """Files by version, the one that counts last."""
    found: dict[int, list[str]] = {}
    for name in sorted(n for n in names(spark, log) if n.endswith(".json") and n[0] != "."):
        found.setdefault(int(name.split("-")[0].removesuffix(".json")), []).append(name)
    return found


def versions(spark: SparkSession, log: str) -> list[int]:
    return sorted(_published(spark, log))


def latest(spark: SparkSession, log: str, upto: int | None = None) -> Tables:
    """The tables as of the newest version, or the newest one up to ``upto``."""
    found = {v: files for v, files in _published(spark, log).items() if upto is None or v <= upto}
    if not found:
        return {}
    text = spark.read.text(f"{log}/{found[max(found)][-1]}", wholetext=True).first()[0]
    return {path: {int(b): v for b, v in held.items()} for path, held in json.loads(text).items()}


def publish(spark: SparkSession, log: str, version: int, changed: Tables) -> None:
    """Publish a version: the one before, with the tables given replaced. Repeating it replaces it."""
    base = latest(spark, log, version if version == 0 else version - 1)
    again = len(_published(spark, log).get(version, []))
    fs, target = _open(spark, f"{log}/{version:020d}-{again:06d}.json")
    _, draft = _open(spark, f"{log}/.{version}-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(base | changed).encode()))
    out.close()
    if not fs.rename(draft, target):
        raise OSError(f"version {version} could not be published in {log}")


def prune(spark: SparkSession, log: str, keep: int = 2) -> None:
    """Remove all versions but the newest ``keep``, and the data only they used."""
    every = versions(spark, log)
    old, kept = every[:-keep], every[-keep:]
    if not old:
        return
    used: dict[str, set] = {}
    for v in kept:
        for path, held in latest(spark, log, v).items():
            used.setdefault(path, set()).update((b, n) for b, n in held.items() if n is not None)
    for path, pairs in used.items():
        for folder in names(spark, path):
            if folder.startswith("v=") and int(folder[2:]) <= old[-1]:
                number = int(folder[2:])
                for part in names(spark, f"{path}/{folder}"):
                    if part.startswith("_bucket=") and (int(part[8:]), number) not in pairs:
                        remove(spark, f"{path}/{folder}/{part}")
    for v, files in _published(spark, log).items():
        for name in files if v in old else files[:-1]:
            remove(spark, f"{log}/{name}")
