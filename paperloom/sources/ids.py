"""Stable ids inside table functions; the same values as ``functions.identity`` gives for columns."""

from __future__ import annotations

import base64
import hashlib
import json


def canonical(value) -> bytes:
    """Canonical JSON: sorted keys, no spaces, UTF-8; the fields of a header that change per run are left out."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain({f: y for f, y in v.items() if f not in ("content_hash", "created_at")} if k == "header" and isinstance(v, dict) else v) for k, v in x.items()}
        return [plain(y) for y in x] if isinstance(x, list) else x

    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False).encode()


def content_hash(value) -> str:
    return hashlib.sha256(canonical(value)).hexdigest()


def stable(prefix: str, length: int = 26, **fields) -> str:
    digest = base64.b32encode(hashlib.sha256(canonical(fields)).digest()).decode().lower()
    return f"{prefix}_{digest.rstrip('=')[:length]}"
