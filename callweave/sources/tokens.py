"""Tokens of Java and Kotlin texts, with places and matching brackets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

#: White space before a token is part of its match; kinds differ by their first character, so the frequent ones come first.
_PATTERN = r"""\s*+(?:
 (?P<name>[^\W\d][\w$]*|\$[\w$]*|`[^`]*`)
|(?P<skip>//[^\n]*|/\*.*?(?:\*/|\Z)|\Z)
|(?P<text>\"{3}.*?\"{3}|"(?:\\.|\$\{[^}]*\}|[^"\\\n])*"|'(?:\\.|[^'\\\n])*')
|(?P<number>\.?\d[\w.]*)
|(?P<op>->|::|\?\.|\?:|!!|\.\.\.|===|!==|&&|\|\||==|!=|<=|>=|\+\+|--|[-+*/%&|^]=|.)
)"""
_TOKEN = re.compile(_PATTERN, re.X | re.S)
_OPEN = {"(": ")", "[": "]", "{": "}"}
_CLOSE = frozenset(_OPEN.values())


class Token(NamedTuple):
    kind: str
    text: str
    start: int
    line: int


def tokens(text: str) -> Iterator[Token]:
    """The tokens of a text one after another; who needs only the first reads no further."""
    line, counted = 1, 0
    for m in _TOKEN.finditer(text):
        if (kind := m.lastgroup) != "skip":
            start = m.start(kind)
            line, counted = line + text.count("\n", counted, start), start
            yield Token(kind, m[kind], start, line)


class Source:
    """The tokens of a text; close[k] is the place of the bracket that closes token k, or the last place."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.tokens = list(tokens(text))
        self.close: dict[int, int] = {}
        open_at: list[int] = []
        for k, (kind, sign, _, _) in enumerate(self.tokens):
            if kind != "op":
                continue
            if sign in _OPEN:
                open_at.append(k)
            elif sign in _CLOSE:
                while open_at and _OPEN[self.tokens[open_at[-1]].text] != sign:
                    open_at.pop()
                if open_at:
                    self.close[open_at.pop()] = k
        #: The opening place of each closing bracket.
        self.open = {c: k for k, c in self.close.items()}
        for k in open_at:
            self.close[k] = len(self.tokens) - 1

    def at(self, k: int) -> str:
        """The text of token k, empty outside."""
        return self.tokens[k].text if 0 <= k < len(self.tokens) else ""

    def is_name(self, k: int) -> bool:
        return 0 <= k < len(self.tokens) and self.tokens[k].kind == "name"

    def raw(self, first: int, end: int) -> str:
        """The source from token `first` up to the end of token end - 1."""
        if first >= end:
            return ""
        return self.text[self.tokens[first].start : self.tokens[end - 1].start + len(self.tokens[end - 1].text)]

    def top(self, first: int, end: int):
        """Places in [first, end) outside brackets that open in it."""
        k = first
        while k < end:
            yield k
            k = self.close[k] + 1 if k in self.close and self.at(k) in _OPEN else k + 1

    def split(self, first: int, end: int, sign: str = ",") -> list[tuple[int, int]]:
        """The ranges between top-level signs."""
        cuts = [k for k in self.top(first, end) if self.at(k) == sign]
        return [(a, b) for a, b in zip([first, *(c + 1 for c in cuts)], [*cuts, end], strict=True) if a < b]
