"""Shared by test modules; fixtures are in ``conftest.py``."""

from __future__ import annotations

import os

SMOKE_DIR = "/root/testdata/sf0.001"


def write_text(path: str, name: str, text: str) -> str:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    with open(full, "w") as fh:
        fh.write(text)
    return full
