"""Splitting a text into the pre-tokens of the byte-level vocabularies."""

from __future__ import annotations

import re

import regex

# Fixed value: the published pattern of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same pattern for texts whose characters all lie in PLAIN, with the
# property classes written out, which the plain re module matches faster.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = r"\t-\r \u0085 "
_PLAIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACES}{_LETTERS}{_DIGITS}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
_ODD = re.compile("[^\u0000-ɏ‐-‧‰-⁞₠-₿]")
_ANY = regex.compile(PATTERN)


def is_plain(text: str) -> bool:
    return text.isascii() or _ODD.search(text) is None


def pretokens(text: str) -> list[str]:
    return _PLAIN.findall(text) if is_plain(text) else _ANY.findall(text)
