"""Files of own formats in the shared folder, written and read by tasks.

Paths are URIs that Arrow's file systems open (local, HDFS, S3, ...).  A task
writes to a name of its own and moves it into place when it is complete; a
retried task writes another file and only the names that a successful task
returned are ever read, so a lost executor or a second attempt is harmless.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def new_file(folder: str, stem: str, suffix: str):
    """Yields (stream, uri) of a file that appears under ``uri`` at the end."""
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    with fs.open_output_stream(f"{base}/_{name}", compression=None) as out:
        yield out, f"{folder}/{name}"
    fs.move(f"{base}/_{name}", f"{base}/{name}")


@contextmanager
def random_access(uri: str):
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        yield f
