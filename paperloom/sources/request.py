"""Requests: what to ingest and under which policies. Normalized, checked and hashed on the driver."""

from __future__ import annotations

import posixpath
from urllib.parse import urlparse

from .ids import content_hash, stable

# Defaults of a request ------------------------------------------------------------------------------------
BUDGET = {"source_bytes": 2_147_483_648, "decompressed_bytes": 8_589_934_592, "parts": 100_000, "memory_bytes": 2_147_483_648, "cpu_seconds": 300, "wall_seconds": 1_800, "temp_bytes": 8_589_934_592}
MAX_SOURCES = 10_000


class RequestError(ValueError):
    """A request that can't be run; ``code`` says why."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def for_path(path: str) -> dict:
    """A request for one file or folder with the default policies."""
    return {"sources": [{"locator_id": stable("locator", path=path), "kind": "local_file", "role": "primary", "uri": path}], "rendering_policy": {"mode": "none", "profiles": []}, "security_policy": {"network": "deny", "encryption": "secret"}, "resource_budget": dict(BUDGET)}


def normalized(request: dict) -> dict:
    """The request with absolute paths, default budgets and its own hash.

    Refused: no or too many sources, repeated locators, URLs without host or with another scheme, relative parts that
    lead up, render modes that contradict their profiles, negative budgets, and a hash that isn't the content's.
    """
    claimed = request.get("content_hash")
    body = {k: v for k, v in request.items() if k != "content_hash"}
    if claimed is not None and claimed != content_hash(body):
        raise RequestError("DS-REQ-002", "the hash is not that of the request")
    sources = body.get("sources") or []
    if not 0 < len(sources) <= MAX_SOURCES:
        raise RequestError("DS-REQ-001", "a request has 1 to 10000 sources")
    names = [s.get("locator_id") for s in sources]
    if len(set(names)) < len(names) or None in names:
        raise RequestError("DS-REQ-001", "locators are unique")
    out = []
    for s in sources:
        uri = s.get("uri", "")
        if s.get("kind") == "url":
            parsed = urlparse(uri)
            if parsed.scheme not in ("http", "https") or not parsed.netloc:
                raise RequestError("DS-REQ-001", f"not a URL: {uri!r}")
        elif s.get("kind") in ("local_file", "archive", "directory"):
            if not urlparse(uri).scheme:
                uri = posixpath.normpath(posixpath.join("/", uri) if uri.startswith("/") else posixpath.abspath(uri))
        out.append(s | {"uri": uri})
    budget = BUDGET | (body.get("resource_budget") or {})
    if any(v < 0 for v in budget.values()):
        raise RequestError("DS-REQ-001", "budgets aren't negative")
    rendering = {"mode": "none", "profiles": []} | (body.get("rendering_policy") or {})
    if rendering["mode"] not in ("none", "on_demand", "required") or (rendering["mode"] == "none" and rendering["profiles"]):
        raise RequestError("DS-REQ-001", "no profiles without rendering")
    body |= {"sources": out, "resource_budget": budget, "rendering_policy": rendering}
    return body | {"content_hash": content_hash(body)}
