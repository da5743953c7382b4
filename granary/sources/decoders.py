"""Decoders for sources.paragraphs that need no further library."""

from __future__ import annotations

import json
from collections.abc import Iterator


def json_lines(stream) -> Iterator[dict]:
    """The objects of a binary file of JSON lines."""
    for line in stream:
        if line.strip():
            yield json.loads(line)
