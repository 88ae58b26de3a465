"""Files of this subpackage's own formats in the shared folder, from tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path there; a path without a scheme is a local one."""
    if uri.startswith("/"):
        uri = f"file://{uri}"
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri.removeprefix('file:')}"
    return pafs.FileSystem.from_uri(uri)


class NewFile:
    """A file that appears under its name only when it is whole.

    Each attempt of a task writes a name of its own, so a repeated or
    speculative attempt never meets the file of another; rows that a task
    returns name the files of that very attempt.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.fs, root = _file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"
        self.uri = f"{folder.rstrip('/')}/{self.name}"
        self._part, self._final = f"{root}/.{self.name}.part", f"{root}/{self.name}"
        self._out = self.fs.open_output_stream(self._part, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Appends and returns the offset at which the data starts."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()
        self.fs.move(self._part, self._final)


def open_file(uri: str):
    """A file that can be read at any offset."""
    fs, path = _file_system(uri)
    return fs.open_input_file(path)
