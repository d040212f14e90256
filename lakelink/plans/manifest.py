"""Signed manifests of finished outputs, on the driver."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
from pathlib import Path

VERSION = 1


def canonical(x: object) -> bytes:
    return json.dumps(x, sort_keys=True, separators=(",", ":"), allow_nan=False, ensure_ascii=False).encode()


def sha256(x: object) -> str:
    return hashlib.sha256(canonical(x)).hexdigest()


def fingerprint(path: str | Path) -> dict:
    """Size and SHA-256 of a file, or of the names and contents of a folder's files."""
    p, h, size = Path(path), hashlib.sha256(), 0
    for f in sorted(p.rglob("*")) if p.is_dir() else [p]:
        if f.is_file():
            if p.is_dir():
                h.update(str(f.relative_to(p)).encode())
            with f.open("rb") as fh:
                while block := fh.read(1 << 20):
                    h.update(block)
                    size += len(block)
    return {"size": size, "sha256": h.hexdigest()}


def save(path: str | Path, meta: dict, artifacts: dict[str, str]) -> dict:
    body = meta | {"completed": True, "schema_version": VERSION, "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "artifacts": {k: {"path": str(v)} | fingerprint(v) for k, v in artifacts.items()}}
    body["content_hash"] = sha256(body)
    tmp = Path(f"{path}.tmp")
    with tmp.open("wb") as f:
        f.write(canonical(body))
        f.flush()
        os.fsync(f.fileno())
    tmp.replace(path)
    return body


def _within(want: object, got: object) -> bool:
    return all(k in got and _within(v, got[k]) for k, v in want.items()) if isinstance(want, dict) and isinstance(got, dict) else want == got


def valid(path: str | Path, expected: dict, artifacts: dict[str, str]) -> bool:
    """Whether a manifest is whole, says what is expected, and its artifacts are unchanged; any error is no."""
    try:
        body = json.loads(Path(path).read_bytes())
        stamp = body.pop("content_hash")
        return (body["completed"] is True and body["schema_version"] == VERSION and stamp == sha256(body) and _within(expected, body) and set(body["artifacts"]) == set(artifacts)
                and all({k: body["artifacts"][n][k] for k in ("size", "sha256")} == fingerprint(p) for n, p in artifacts.items()))
    except (OSError, ValueError, KeyError, TypeError, AttributeError):
        return False


def invalidate(folder: str | Path, stages: list[str], start: str) -> list[str]:
    """Delete the manifests of a stage and those after it."""
    gone = []
    for s in stages[stages.index(start):]:
        p = Path(folder) / f"{s}_manifest.json"
        if p.exists():
            p.unlink()
            gone.append(s)
    return gone


def run_folder(root: str | Path, run_id: str) -> Path:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,79}", run_id):
        raise ValueError(f"bad run id {run_id!r}")
    return Path(os.environ.get("LAKELINK_RUNS", root)) / run_id
