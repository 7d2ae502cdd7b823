"""Folders that the driver and all executors share, as pyarrow sees them: local paths, file: URIs, and those of stores that it knows."""

from __future__ import annotations

import os

import pyarrow.fs


def located(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path) of a path or URI."""
    local = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    if "://" in local:
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(local)
