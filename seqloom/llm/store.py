"""Files in the shared folder, by URI, from the driver or an executor: local, HDFS or object stores that pyarrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def attempt_file(folder: str, suffix: str) -> str:
    """A name that no other task or attempt takes; only the manifest of attempts that ended makes it part of a result."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


class Writer:
    def __init__(self, uri: str):
        self.system, self.path = opened(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.system.open_output_stream(self.path, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()


def reader(uri: str):
    """A file that can seek."""
    system, path = opened(uri)
    return system.open_input_file(path)
