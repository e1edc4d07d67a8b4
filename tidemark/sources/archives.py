"""Acquisition of an archive: download checks, ZIP inspection, safe extraction, identity. Driver-side."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import zipfile
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path, PurePosixPath, PureWindowsPath
from typing import BinaryIO
from urllib.request import Request, urlopen

from tidemark.operators.guards import require

METADATA_KEYS = ("archive_filename", "compressed_bytes", "sha256", "archive_members")


def sha256_of(path: str | Path, chunk_bytes: int = 1 << 20) -> str:
    require(chunk_bytes > 0, "chunk_bytes must be positive")
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def copied(source: BinaryIO, target: str | Path, chunk_bytes: int = 1 << 20) -> tuple[int, str]:
    """Copies a stream into a file and returns its bytes and SHA-256, in one pass."""
    require(chunk_bytes > 0, "chunk_bytes must be positive")
    total, digest = 0, hashlib.sha256()
    with open(target, "wb") as out:
        while block := source.read(chunk_bytes):
            out.write(block)
            digest.update(block)
            total += len(block)
    return total, digest.hexdigest()


def check_member_name(name: str) -> None:
    """Refuses absolute, drive-qualified and parent paths."""
    posix, windows = PurePosixPath(name.replace("\\", "/")), PureWindowsPath(name)
    require(not posix.is_absolute() and not windows.is_absolute() and not windows.drive and ".." not in posix.parts, f"unsafe archive member: {name}")


def inspect_zip(path: str | Path) -> list[dict]:
    """Members of a sound, non-empty ZIP with safe names."""
    require(zipfile.is_zipfile(path), f"{path} is not a ZIP archive")
    with zipfile.ZipFile(path) as z:
        members = z.infolist()
        require(bool(members), "the archive is empty")
        for m in members:
            check_member_name(m.filename)
        bad = z.testzip()
        require(bad is None, f"checksum of {bad} fails")
        return [{"filename": m.filename, "compressed_bytes": m.compress_size, "uncompressed_bytes": m.file_size, "crc32": f"{m.CRC:08x}", "is_directory": m.is_dir()} for m in members]


def check_free_space(folder: str | Path, expected_bytes: int, multiplier: int = 2) -> int:
    """Free bytes of a folder; less than expected times multiplier is an error."""
    require(multiplier >= 2, "the multiplier must be at least 2")
    at = Path(folder)
    while not at.exists():
        at = at.parent
    free = shutil.disk_usage(at).free
    require(free >= expected_bytes * multiplier, f"{free} bytes are free, {expected_bytes * multiplier} are needed")
    return free


def load_metadata(path: str | Path) -> dict:
    said = json.loads(Path(path).read_text(encoding="utf-8"))
    missing = [k for k in METADATA_KEYS if k not in said]
    require(not missing, f"snapshot metadata lacks {', '.join(missing)}")
    return said


def verify_archive(path: str | Path, metadata: dict) -> None:
    """The archive's name, size and SHA-256 must be those of its metadata."""
    file = Path(path)
    require(file.name == metadata["archive_filename"], "archive name differs from its metadata")
    require(file.stat().st_size == metadata["compressed_bytes"], "archive size differs from its metadata")
    require(sha256_of(file) == metadata["sha256"], "archive SHA-256 differs from its metadata")


def published(target: str | Path, write: Callable[[Path], object], overwrite: bool = False):
    """Writes a file beside the target and renames it; nothing is left behind on an error."""
    target = Path(target)
    if target.exists() and not overwrite:
        raise FileExistsError(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    try:
        out = write(part)
        os.replace(part, target)
        return out
    finally:
        part.unlink(missing_ok=True)


def extract_member(archive: str | Path, member: str, target: str | Path, overwrite: bool = False, chunk_bytes: int = 1 << 20) -> dict:
    """Extracts one member: safe name, free space, byte count; returns its provenance."""
    check_member_name(member)
    with zipfile.ZipFile(archive) as z:
        info = z.getinfo(member)
        check_free_space(Path(target).parent, info.file_size, 2)

        def write(part: Path) -> tuple[int, str]:
            with z.open(info) as source:
                total, digest = copied(source, part, chunk_bytes)
            require(total == info.file_size, "extracted size differs from the archive's")
            return total, digest

        total, digest = published(target, write, overwrite)
    return {"member": member, "path": str(target), "bytes": total, "sha256": digest, "crc32": f"{info.CRC:08x}"}


def acquire(url: str, target: str | Path, metadata_path: str | Path, expected_bytes: int, *, timeout: int = 120, chunk_bytes: int = 1 << 20, multiplier: int = 5, overwrite: bool = False, open_url: Callable = urlopen, about: dict | None = None) -> dict:
    """Downloads one reviewed archive and writes its provenance.

    Status, content type, announced and received sizes must be the reviewed ones.
    """
    free = check_free_space(Path(target).parent, expected_bytes, multiplier)

    def write(part: Path) -> tuple[int, str, list[dict]]:
        with open_url(Request(url, headers={"User-Agent": "tidemark"}), timeout=timeout) as response:
            require(response.status == 200, f"status {response.status}")
            require("zip" in (response.headers.get("Content-Type") or "").lower(), "the response is not a ZIP")
            require(int(response.headers.get("Content-Length") or -1) == expected_bytes, "announced size differs from the reviewed size")
            total, digest = copied(response, part, chunk_bytes)
        require(total == expected_bytes, "received size differs from the reviewed size")
        return total, digest, inspect_zip(part)

    total, digest, members = published(target, write, overwrite)
    said = {"archive_url": url, "downloaded_at": datetime.now(UTC).isoformat(), "archive_filename": Path(target).name, "compressed_bytes": total, "sha256": digest, "free_bytes_before": free, "archive_members": members} | (about or {})
    published(metadata_path, lambda p: p.write_text(json.dumps(said, indent=2), encoding="utf-8"), True)
    return said
