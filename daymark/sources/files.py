"""Opening paths inside tasks on any filesystem pyarrow knows."""

from __future__ import annotations

import re

from pyarrow import fs


def open_path(path: str):
    """Seekable binary stream of ``path`` (local, hdfs, s3, ...)."""
    filesystem, inner = resolve(path)
    return filesystem.open_input_file(inner)


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[a-z0-9]+:/", path):
        uri = re.sub(r"^file:/+", "file:///", path)
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), path


def list_files(path: str, suffix: str) -> list[str]:
    """The file itself, or the files with ``suffix`` below a folder at any depth, in path order."""
    filesystem, inner = resolve(path)
    info = filesystem.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    below = len(inner.rstrip("/")) + 1
    names = sorted(f.path[below:] for f in filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
                   if f.type == fs.FileType.File and f.base_name.lower().endswith(suffix))
    return [f"{path.rstrip('/')}/{n}" for n in names]
