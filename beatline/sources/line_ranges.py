"""Lines of byte ranges of files, as Arrow batches. Runs in Spark's Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs

#: Bytes read at a time.
BLOCK = 8 << 20

_MARK = b"\xef\xbb\xbf"


def opens(scheme: str) -> bool:
    """Whether files of this scheme can be opened without Spark's own readers."""
    if scheme in ("", "file"):
        return True
    try:
        fs.FileSystem.from_uri(f"{scheme}://host/")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, which is not percent-encoded, and the path there."""
    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if sep else path).lstrip("/")
    authority, _, name = rest.removeprefix("//").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{name}" if root.strip("/") else f"/{name}"


def _changed(system: fs.FileSystem, name: str) -> tuple[int, int]:
    """(length, time of the last change in nanoseconds)."""
    info = system.get_file_info(name)
    if info.type != fs.FileType.File:
        raise FileNotFoundError(name)
    return info.size, info.mtime_ns or 0


def line_start(file, at: int, size: int) -> int:
    """The first place from ``at`` on where a line begins, ``size`` if there is none."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size)
    file.seek(at - 1)
    place = at - 1
    while block := file.read(min(BLOCK, size - place)):
        found = [i for i in (block.find(b"\n"), block.find(b"\r")) if i >= 0]
        if found:
            end = min(found)
            after = place + end + 1
            if block[end : end + 1] == b"\r" and after < size:
                file.seek(after)
                after += file.read(1) == b"\n"
            return after
        place += len(block)
    return size


def _blocks(file, begin: int, end: int) -> Iterator[bytes]:
    """Bytes ``begin`` to ``end``, both line starts, in blocks of whole lines that end with a line feed each."""
    file.seek(begin)
    held, left = b"", end - begin
    while left:
        block = file.read(min(BLOCK, left))
        if not block:
            raise EOFError("a file is shorter than its plan says")
        left -= len(block)
        held += block
        # A carriage return at the very end may be half of a pair.
        cut = len(held) if not left else 1 + max(held.rfind(b"\n"), held.rfind(b"\r", 0, len(held) - 1))
        if cut:
            lines, held = held[:cut], held[cut:]
            if b"\r" in lines:
                lines = lines.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            yield lines if lines.endswith(b"\n") else lines + b"\n"


def _lines(block: bytes) -> pa.Array:
    """The lines of a block without their line feeds; those that are not UTF-8 are left out."""
    raw = np.frombuffer(block, np.uint8)
    ends = np.flatnonzero(raw == 10)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    data = pa.py_buffer(raw[raw != 10].tobytes())
    texts = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), data)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array([t for x in texts.cast(pa.binary()).to_pylist() if (t := _text(x)) is not None], pa.string())
    return texts


def _text(raw: bytes) -> str | None:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def range_lines(path: str, begin: int, end: int, length: int, changed: int | None) -> Iterator[pa.Array]:
    """Lines that begin from ``begin`` to before ``end``. Refuses a file of another length or time of change."""
    system, name = _locate(path)
    now = _changed(system, name)
    if now != (length, now[1] if changed is None else changed):
        raise RuntimeError(f"{path} has changed since its lines were counted")
    with system.open_input_file(name) as file:
        first = line_start(file, begin, length)
        last = line_start(file, end, length)
        if begin == 0:
            file.seek(0)
            if file.read(3) == _MARK:
                first = 3
        for block in _blocks(file, first, max(first, last)):
            yield _lines(block)


def count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges (path, length, begin, end) with their count of lines and the file's time of change."""
    for batch in batches:
        for r in batch.to_pylist():
            changed = _changed(*_locate(r["path"]))[1]
            n = sum(len(x) for x in range_lines(r["path"], r["begin"], r["end"], r["length"], changed))
            row = {"path": r["path"], "length": r["length"], "changed": changed, "begin": r["begin"], "end": r["end"], "n": n}
            yield pa.RecordBatch.from_pylist([row])


def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbered lines of planned ranges."""
    for batch in batches:
        for r in batch.to_pylist():
            at = r["base"]
            for texts in range_lines(r["path"], r["begin"], r["end"], r["length"], r["changed"]):
                idx = pa.array(np.arange(at, at + len(texts)))
                at += len(texts)
                names = pa.repeat(pa.scalar(r["record"], pa.string()), len(texts))
                yield pa.RecordBatch.from_arrays([names, idx, texts], ["record", "idx", "text"])
