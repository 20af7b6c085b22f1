"""Files of a storage that driver and executors share, by path or URI, without a session.

Python data sources run in processes that have no JVM, so they reach storage through this module.
"""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs

COPY = 8 << 20


def of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; `file:` and plain paths are local ones."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return fs.LocalFileSystem(), os.path.abspath(path)


def kind(system: fs.FileSystem, path: str) -> str:
    """`file`, `folder` or `absent`."""
    found = system.get_file_info(path).type
    return {fs.FileType.File: "file", fs.FileType.Directory: "folder"}.get(found, "absent")


def visible(system: fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """(path, bytes) of the file, or of the files below the folder, in order of their paths.

    As Spark does, names that begin with `_` or `.` are passed over, and what is below them.
    """
    if kind(system, root) == "file":
        return [(root, system.get_file_info(root).size)]
    if kind(system, root) == "absent":
        return []
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    below = len(root.rstrip("/")) + 1
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and not any(p[0] in "_." for p in f.path[below:].split("/")))


def cut(system: fs.FileSystem, path: str, size: int) -> None:
    """Keeps the first `size` bytes: in place on a local disk, else by a copy that replaces the file."""
    if isinstance(system, fs.LocalFileSystem):
        os.truncate(path, size)
        return
    part = f"{path.rpartition('/')[0]}/_{path.rpartition('/')[2]}.part"
    with system.open_input_file(path) as old, system.open_output_stream(part) as new:
        while size > 0 and (data := old.read(min(COPY, size))):
            new.write(data)
            size -= len(data)
    system.delete_file(path)
    system.move(part, path)


def extend(system: fs.FileSystem, path: str, sources: list[str], head: bytes = b"") -> None:
    """Adds `head` and then the files' contents to the end of a file, a block at a time."""
    with system.open_append_stream(path) as out:
        out.write(head)
        for source in sources:
            with system.open_input_file(source) as data:
                while block := data.read(COPY):
                    out.write(block)


def put(path: str, content: bytes) -> None:
    """Writes a file beside its place and renames it, so that nobody ever sees half of it."""
    system, at = of(path)
    folder, _, name = at.rpartition("/")
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    system.create_dir(folder, recursive=True)
    try:
        with system.open_output_stream(part) as out:
            out.write(content)
        if isinstance(system, fs.LocalFileSystem):
            with open(part, "rb") as written:
                os.fsync(written.fileno())
        system.move(part, at)
    finally:
        if kind(system, part) == "file":
            system.delete_file(part)
