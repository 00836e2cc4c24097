"""Committed sets of files in a store that every task can reach.

Tasks write files under names of their own; the set is committed by one manifest, written on
the driver after all tasks have ended well, that lists the files in order. A file of a lost or
repeated task is in no manifest, so nobody reads it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql.datasource import InputPartition, WriterCommitMessage

MANIFEST = "manifest.json"


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """file:, hdfs:, s3:, gs: and abfs: addresses, and plain local paths."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def fresh_file(folder: str, suffix: str) -> str:
    """A name that no other attempt uses; the folder is made."""
    fs, base = resolve(folder)
    fs.create_dir(base, recursive=True)
    return f"{folder.rstrip('/')}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}{suffix}"


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: str
    items: int
    units: int


@dataclass
class FilePart(InputPartition):
    file: str
    first_unit: int

    def __init__(self, file: str, first_unit: int):
        super().__init__((file, first_unit))
        self.file, self.first_unit = file, first_unit


def commit(folder: str, messages: list) -> None:
    """Writes the manifest: files by partition, each with the number of units before it."""
    done = sorted((m for m in messages if m is not None and m.items), key=lambda m: m.partition)
    entries, before = [], 0
    for m in done:
        entries.append({"file": m.file.rsplit("/", 1)[-1], "items": m.items, "units": m.units, "before": before})
        before += m.units
    fs, base = resolve(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{MANIFEST}") as out:
        out.write(json.dumps({"files": entries}).encode())


def abort(messages: list) -> None:
    for m in messages:
        if m is not None:
            fs, path = resolve(m.file)
            fs.delete_file(path)


def parts(folder: str) -> list[FilePart]:
    fs, base = resolve(folder)
    with fs.open_input_stream(f"{base}/{MANIFEST}") as src:
        listed = json.loads(src.read())["files"]
    return [FilePart(f"{folder.rstrip('/')}/{e['file']}", e["before"]) for e in listed]
