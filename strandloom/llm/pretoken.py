"""The pattern that byte-level tokenizers split text with, for whole batches of texts."""

from __future__ import annotations

import functools
import re

import public_tokenizers
import regex

#: The code points with Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def _ranges(kind: str) -> str:
    """A character class body of the basic plane's code points of a kind."""
    plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    runs = regex.findall(rf"{kind}+", plane)
    return "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)


@functools.lru_cache(1)
def _matchers() -> tuple:
    """The pattern for texts of the basic plane, with classes spelt out for the faster module, and for all others."""
    classes = {r"\p{L}": _ranges(r"\p{L}"), r"\p{N}": _ranges(r"\p{N}"), r"\s": WHITE}
    pattern = public_tokenizers.PATTERN
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(classes.values()) + "]")
    pattern = pattern.replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"\s", f"[{WHITE}]")
    for kind in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(kind, f"[{classes[kind]}]")
    full = public_tokenizers.PATTERN.replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"[^\s", f"[^{WHITE}")
    full = full.replace(r"\s+", f"[{WHITE}]+")
    return re.compile(pattern).findall, regex.compile(full).findall


def pretokens(text: str) -> list[str]:
    """All matches of the pattern in a text, in order."""
    basic, full = _matchers()
    return basic(text) if text.isascii() or len(text.encode("utf-16-le", "replace")) == 2 * len(text) else full(text)
