"""Files that tasks reach without Spark's readers: a folder's file system and path."""

from __future__ import annotations

from pyarrow import fs


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a plain path or a URI that pyarrow knows (``file:``, ``hdfs:``, object stores)."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path[len("file:"):]
    return fs.LocalFileSystem(), path


def files_below(place: fs.FileSystem, folder: str, limit: int) -> list[fs.FileInfo]:
    """Files below a folder by path, without hidden ones and those that are being written; none if there is no folder."""
    found = place.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    start = len(folder.rstrip("/")) + 1
    files = [
        f for f in found
        if f.type == fs.FileType.File and not any(part[0] in "._" for part in f.path[start:].split("/"))
    ]
    if len(files) > limit:
        raise ValueError(f"more than {limit} files below {folder}")
    return sorted(files, key=lambda f: f.path)
