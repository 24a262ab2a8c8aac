"""Files in shared storage from the Python workers, by URI (file, hdfs, s3, gs, ...)."""

from __future__ import annotations

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Committed:
    """A file written under a temporary name that only close() gives its real one; a second try replaces it whole."""

    def __init__(self, uri: str, attempt: str):
        self.fs, self.path = at(uri)
        self.temporary = f"{self.path}.{attempt}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)

    def abandon(self) -> None:
        """Closes and removes the temporary file."""
        self.stream.close()
        self.fs.delete_file(self.temporary)


def write_whole(uri: str, data: bytes, attempt: str) -> None:
    """A small file, committed by rename."""
    out = Committed(uri, attempt)
    out.write(data)
    out.close()


def read_whole(uri: str) -> bytes:
    where, path = at(uri)
    with where.open_input_stream(path, compression=None) as f:
        return f.read()
