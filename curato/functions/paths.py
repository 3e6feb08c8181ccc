"""Steps of VARIANT paths."""

from __future__ import annotations


def field(name: str) -> str:
    """The step to an object's field: ``.name``, or in brackets where the name is no
    plain word.  A name that no path can hold raises."""
    if name.replace("_", "").isalnum() and name.isascii():
        return f".{name}"
    for quote in "'\"":
        if name and quote not in name and "?" not in name:
            return f"[{quote}{name}{quote}]"
    raise ValueError(f"a field named {name!r} cannot be reached by a path")
