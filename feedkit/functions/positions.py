"""Positions of fixed-width fields. Three conventions are in use; the caller names the one meant."""

from __future__ import annotations

from collections.abc import Sequence

from feedkit.functions.types import one_of

POSITIONS = ("start_length", "start_end", "widths")

Span = tuple[str, int, int]


def spans(properties: Sequence[dict], positions: str) -> list[Span]:
    """``(name, start, length)`` per property; start counts from 1.

    ``start_length``: ``"5,9"`` is nine characters from the fifth.
    ``start_end``: ``"3,6"`` is the third to the sixth character, both included.
    ``widths``: ``"10"``, fields follow each other.
    """
    one_of(positions, POSITIONS, "positions")
    result, next_start = [], 1
    for field in properties:
        numbers = [int(n) for n in str(field["position"]).split(",")]
        expected = 1 if positions == "widths" else 2
        if len(numbers) != expected:
            raise ValueError(f"position {field['position']!r} of {field['name']} is not of the form {positions}")
        if positions == "widths":
            start, length = next_start, numbers[0]
        elif positions == "start_length":
            start, length = numbers
        else:
            start, length = numbers[0], numbers[1] - numbers[0] + 1
        if start < 1 or length < 1:
            raise ValueError(f"position {field['position']!r} of {field['name']} is empty or starts before 1")
        result.append((field["name"], start, length))
        next_start = start + length
    return result
