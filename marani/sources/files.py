"""Single files on any file system: paths may be local or an address such as hdfs://, s3:// or gs://."""

from __future__ import annotations

import os
from collections.abc import Iterable
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyarrow import fs


def where(path: str) -> tuple[fs.FileSystem, str]:
    from pyarrow import fs  # starts threads of its own, so only where a file is opened

    return fs.FileSystem.from_uri(path)


def _local(path: str) -> str | None:
    """The local path that a path or file address stands for; None for other addresses."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else path


def write(path: str, parts: Iterable[bytes]) -> int:
    """Write a file part by part and return its length."""
    if (own := _local(path)) is not None:
        os.makedirs(os.path.dirname(own) or ".", exist_ok=True)
        stream = open(own, "wb")  # noqa: SIM115
    else:
        system, at = where(path)
        system.create_dir(at.rpartition("/")[0], recursive=True)
        stream = system.open_output_stream(at)
    length = 0
    with stream as f:
        for part in parts:
            f.write(part)
            length += len(part)
    return length


def size(path: str) -> int | None:
    """The length of a file; None if there is none."""
    if (own := _local(path)) is not None:
        return os.path.getsize(own) if os.path.isfile(own) else None
    system, at = where(path)
    found = system.get_file_info(at)
    return found.size if found.is_file else None


def read(path: str, start: int = 0, length: int | None = None) -> bytes:
    if (own := _local(path)) is not None:
        with open(own, "rb") as f:
            f.seek(start)
            return f.read(-1 if length is None else length)
    system, at = where(path)
    with system.open_input_file(at) as f:
        f.seek(start)
        return f.read(f.size() - start if length is None else length)
