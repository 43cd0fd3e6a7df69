"""Strict JSON parsing shared by the nested-record and the drift operators."""

from __future__ import annotations

import json
from typing import Any



class _Invalid:
    def __reduce__(self) -> str:
        # One object in every process, also where a closure carries it.
        return "INVALID"


INVALID = _Invalid()


def _no_constant(name: str) -> Any:
    raise ValueError(name)


_decoder = json.JSONDecoder(parse_constant=_no_constant)


def parse(text: str | None) -> Any:
    """The JSON value that ``text`` is as a whole, or ``INVALID``.

    NaN and Infinity are no JSON.  A string that itself holds JSON stands for the inner
    value, to any depth; any other string is just a string.
    """
    if text is None:
        return INVALID
    try:
        value = _decoder.decode(text)
    except (ValueError, RecursionError):
        return INVALID
    while isinstance(value, str):
        try:
            value = _decoder.decode(value)
        except (ValueError, RecursionError):
            break
    return value
