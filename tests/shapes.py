"""Outlines that several tests share."""

from __future__ import annotations


def square(x0, y0, x1, y1):
    """One-ring polygon as nested lists."""
    return [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]
