"""Files of the shared folders as Python tasks and Python data sources see them."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system behind a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def listed(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """All visible files below a folder by name; none if it is missing. Names that begin with . or _ are hidden."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
    inside = lambda f: f.path[len(folder) :].strip("/").split("/")
    files = [f for f in found if f.type == fs.FileType.File and not any(p.startswith((".", "_")) for p in inside(f))]
    return sorted(files, key=lambda f: f.path)


def write_new(system: fs.FileSystem, path: str, data: bytes) -> None:
    """Write a file that appears whole."""
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, path)


def read_whole(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.read()
