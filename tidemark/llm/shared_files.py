"""Files that tasks write and read below the shared folder, on any file system pyarrow can reach."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, or of a plain path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def fresh(folder: str, ending: str) -> str:
    """A name no other attempt of the task uses. Only attempts that end well come to be listed."""
    return f"{folder}/{uuid.uuid4().hex}{ending}"
