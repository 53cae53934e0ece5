"""Files that tasks write and the driver makes visible, on any store that Arrow opens."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import WriterCommitMessage

MANIFEST = "manifest.json"


@dataclass
class Written(WriterCommitMessage):
    """One file of one task: the partition it came from, its name, and counts of what it holds."""

    partition: int
    name: str
    counts: dict[str, int] = field(default_factory=dict)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_name(suffix: str) -> tuple[int, str]:
    """The task's partition and a file name that no other attempt has."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    return part, f"part-{part:06d}-{uuid.uuid4().hex}{suffix}"


def commit(uri: str, messages: list[Written | None]) -> None:
    """Names the files of the attempts that ended well; readers see only these.

    Files of failed or repeated attempts stay unnamed, so a lost executor does no harm.
    """
    store, path = opened(uri)
    done = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
    rows = [{"partition": m.partition, "name": m.name, **m.counts} for m in done]
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{MANIFEST}") as out:
        out.write(json.dumps(rows).encode())


def manifest(uri: str) -> list[dict]:
    store, path = opened(uri)
    with store.open_input_stream(f"{path}/{MANIFEST}") as source:
        return json.loads(source.read())
