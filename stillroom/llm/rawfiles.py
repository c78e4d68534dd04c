"""Files that tasks write and read themselves, by whatever file system their address names.

A file appears under its name only when it is whole: a task writes it under a name of its own and then renames it. A
task that runs twice, on a retry or in speculation, replaces a file by an equal one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse


#: Names under which Spark knows object stores, and those of pyarrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def located(address: str):
    """The pyarrow file system and the path in it."""
    from pyarrow import fs

    if address.startswith("file:") or "://" not in address:
        return fs.LocalFileSystem(), urlparse(address).path if address.startswith("file:") else address
    scheme, _, rest = address.partition("://")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def make_folder(address: str) -> None:
    files, path = located(address)
    files.create_dir(path, recursive=True)


@contextmanager
def writing(address: str) -> Iterator:
    files, path = located(address)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        yield out
    files.move(attempt, path)


@contextmanager
def reading(address: str) -> Iterator:
    files, path = located(address)
    with files.open_input_file(path) as source:
        yield source
