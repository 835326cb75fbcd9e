"""File access inside a task or for a bounded peek on the driver.

Plain POSIX paths (a mounted share included) use the operating system; URIs go through
Arrow's file systems. Only single files and single directories are touched here: which
ones, and in which task, is decided by the DataFrame jobs in ``files`` and ``archives``.
"""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from typing import Any, BinaryIO

URI = r"^[A-Za-z][A-Za-z0-9+.-]*:/"
_URI = re.compile(URI)
# Schemes that Spark's connectors use, and what Arrow calls the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _remote(path: str) -> tuple[Any, str] | None:
    if not _URI.match(path):
        return None
    from pyarrow import fs

    scheme, rest = path.split(":", 1)
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme.lower(), scheme)}:{rest}")


def open_binary(path: str) -> BinaryIO:
    remote = _remote(path)
    if remote is None:
        return open(path, "rb")
    system, inner = remote
    return system.open_input_file(inner)


def write_binary(path: str, content: bytes) -> None:
    """Write a whole small file under its final name; a retried task simply writes it again."""
    remote = _remote(path)
    if remote is not None:
        system, inner = remote
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(inner) as handle:
            handle.write(content)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}.tmp"
    with open(part, "wb") as handle:
        handle.write(content)
    os.replace(part, path)


def write_again(path: str, content: bytes) -> None:
    """Write a whole small file that nobody reads before the job has ended: one step in its folder, not two.

    The file is never emptied, so another attempt that writes the same bytes changes nothing for readers.
    """
    if _remote(path) is not None:
        write_binary(path, content)
        return
    try:
        handle = os.open(path, os.O_WRONLY | os.O_CREAT, 0o666)
    except FileNotFoundError:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        handle = os.open(path, os.O_WRONLY | os.O_CREAT, 0o666)
    with open(handle, "wb") as out:
        out.write(content)
        out.truncate()


def is_file(path: str) -> bool:
    remote = _remote(path)
    if remote is None:
        return os.path.isfile(path)
    system, inner = remote
    return bool(system.get_file_info(inner).is_file)


def is_dir(path: str) -> bool:
    remote = _remote(path)
    if remote is None:
        return os.path.isdir(path)
    system, inner = remote
    return system.get_file_info(inner).type.name == "Directory"


Entry = tuple[str, bool, int | None, float | None]


def entries(path: str, follow_links: bool = False) -> Iterator[Entry]:
    """(path, is_dir, length, modified seconds) of a directory's entries, or of a file itself.

    Length and time are None where ``looked_up`` has yet to find them; names come page by page.
    With ``follow_links`` a link to a directory counts as one.
    """
    remote = _remote(path)
    if remote is not None:
        yield from _remote_children(path, *remote)
        return
    if not os.path.isdir(path):
        yield path, False, None, None
        return
    with os.scandir(path) as found:
        for entry in found:
            is_dir = entry.is_dir(follow_symlinks=follow_links)
            yield entry.path, is_dir, 0 if is_dir else None, 0.0 if is_dir else None


def looked_up(entry: Entry) -> Entry | None:
    """The entry with its length and time; None if it is gone, a dangling link or no regular file."""
    path, is_dir, length, modified = entry
    if length is not None and length == length:
        return path, is_dir, int(length), modified
    try:
        found = os.stat(path)
    except (FileNotFoundError, NotADirectoryError):
        return None
    return (path, False, found.st_size, found.st_mtime) if stat.S_ISREG(found.st_mode) else None


def children(path: str) -> Iterator[tuple[str, bool, int, float]]:
    """The entries of one directory with lengths and times."""
    return (found for entry in entries(path) if (found := looked_up(entry)) is not None)


def _remote_children(path: str, system: Any, inner: str) -> Iterator[tuple[str, bool, int, float]]:
    from pyarrow import fs

    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else path.split("://")[0] + "://"
    here = system.get_file_info(inner)
    if here.is_file:
        listed = [here]
    else:
        listed = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    for info in listed:
        stamp = info.mtime.timestamp() if info.mtime else 0.0
        yield prefix + info.path, not info.is_file, info.size or 0, stamp
