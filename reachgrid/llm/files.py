"""Files that tasks write and read themselves, on any file system pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI or of an absolute local path.

    ``s3a`` and ``s3n`` are what Hadoop calls ``s3``. Raises for schemes unknown here,
    before anything is written.
    """
    for name in ("s3a://", "s3n://"):
        if uri.startswith(name):
            uri = "s3://" + uri[len(name) :]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """An output stream to a new file; its folder is made where needed."""
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_file(uri: str):
    """A seekable input file."""
    system, path = resolve(uri)
    return system.open_input_file(path)
