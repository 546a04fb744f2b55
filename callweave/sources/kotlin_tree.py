"""Kotlin rules from declarations and expressions: the older mode, by tokens.

Functions that are not local give enter and exit; their bodies give if, when, is and
tracked-write rules in the order in which the expressions begin.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import takewhile

from callweave.sources.tokens import Source, tokens

RuleRow = tuple[str, str, str, int | None, str | None]
_STATEMENT_START = ("{", "}", ";", "->", ")", "else", "")


def _package(text: str) -> str:
    """What follows the first `package` on its line; no token after that line is read."""
    found = tokens(text)
    first = next((t for t in found if t.text == "package"), None)
    if first is None:
        return ""
    return "".join(t.text for t in takewhile(lambda t: t.line == first.line, found) if t.text != ";")


def _expression_end(src: Source, k: int) -> int:
    """The place after an expression body: the first top-level line end that no operator bridges."""
    last = k
    for j in src.top(k, len(src.tokens)):
        t = src.tokens[j]
        if t.text in ("}", ";") or j > k and t.line > src.tokens[last].line and t.text not in (".", "?.", "?:", "&&", "||", "else", "+", "-", "*", "/") and src.at(j - 1) not in ("=", "&&", "||", "?:", "+", "-", "*", "/", "->", "else", "return"):
            return j
        last = src.close.get(j, j)
    return len(src.tokens)


def _parameter_list(src: Source, k: int) -> int | None:
    """The opening parenthesis of a declaration that goes on at k, outside its type parameters; None if it has none."""
    depth = 0
    for j in range(k, len(src.tokens)):
        word = src.at(j)
        if word in ("<", ">"):
            depth += 1 if word == "<" else -1
        elif word == "(" and depth <= 0:
            return j
        elif word in ("{", "}", ";", "=") or src.tokens[j].kind == "name" and word in ("fun", "class", "interface", "object"):
            return None
    return None


def functions(src: Source) -> Iterator[tuple[list[str] | None, str, int, int]]:
    """(class names or None where one is anonymous, name, first, end of the body) of functions that are not local."""
    frames: list[tuple[int, str | None]] = []
    named: dict[int, str | None] = {}
    k = 0
    while k < len(src.tokens):
        word = src.at(k)
        while frames and k >= frames[-1][0]:
            frames.pop()
        if word in ("class", "interface", "object") and src.at(k - 1) not in ("::", "."):
            name = src.at(k + 1) if src.is_name(k + 1) and src.at(k + 1) not in ("where",) else "Companion" if src.at(k - 1) == "companion" else None
            brace = next((j for j in src.top(k + 1, len(src.tokens)) if src.at(j) in ("{", "}", "=", ";") or src.at(j) in ("class", "interface", "object", "fun", "val", "var")), None)
            if brace is not None and src.at(brace) == "{":
                named[brace] = name
        elif word == "{":
            if k in named:
                frames.append((src.close[k], named[k]))
            else:
                k = src.close[k]
        elif word == "fun" and src.tokens[k].kind == "name":
            paren = _parameter_list(src, k + 1)
            if paren is None:
                k += 1
                continue
            start = next((j for j in src.top(src.close[paren] + 1, len(src.tokens)) if src.at(j) in ("{", "=", "}") or src.at(j) in ("fun", "class", "val", "var", "object", "interface")), len(src.tokens))
            names = [name for _, name in frames]
            classes = None if any(n is None for n in names) else names
            if src.at(start) == "{":
                first, end = start + 1, src.close[start]
            elif src.at(start) == "=":
                first, end = start + 1, _expression_end(src, start + 1)
            else:
                first = end = start
            if src.is_name(paren - 1) and src.at(paren - 1) != "fun":
                yield classes, src.at(paren - 1), first, end
            k = max(end, src.close[paren])
            continue
        k += 1


def _operand_start(src: Source, k: int) -> int:
    """Where the postfix expression that ends at k begins."""
    while k > 0:
        if src.at(k) in (")", "]"):
            k = src.open.get(k, k)
            if not src.is_name(k - 1):
                return k
            k -= 1
        elif src.at(k) == "!!":
            k -= 1
        elif src.at(k - 1) in (".", "?."):
            k -= 2
        else:
            return k
    return k


def _type_end(src: Source, k: int) -> int:
    depth = 0
    while src.is_name(k) or src.at(k) in (".", "<", "?", "*") or depth and src.at(k) in (",", ">"):
        depth += {"<": 1, ">": -1}.get(src.at(k), 0)
        k += 1
        if not depth and src.is_name(k) and src.at(k - 1) not in (".", "<", ","):
            break
    return k


def _entries(src: Source, first: int, end: int) -> list[tuple[int, int]]:
    """(first, arrow) of the entries of a when body."""
    out = []
    for arrow in (j for j in src.top(first, end) if src.at(j) == "->"):
        k = arrow - 1
        while k > first and (src.tokens[k - 1].line == src.tokens[k].line and src.at(k - 1) not in (";", "}") or src.at(k - 1) == ","):
            k -= 1
        out.append((k, arrow))
    return out


def body_rules(src: Source, first: int, end: int, tracked: set[str]) -> Iterator[tuple[str, int, str]]:
    """(rule kind, line, text) of a function body."""
    labels: set[int] = set()
    for k in range(first, end):
        t, word = src.tokens[k], src.at(k)
        if t.kind not in ("name", "op"):
            continue
        if word == "if" and src.at(k + 1) == "(":
            text = src.raw(k + 2, src.close[k + 1])
            yield from ((kind, t.line, text) for kind in ("if-true", "if-false"))
        elif word == "when" and src.at(k + 1) in ("(", "{"):
            subject = src.at(k + 1) == "("
            brace = src.close[k + 1] + 1 if subject else k + 1
            yield "when", t.line, src.raw(k + 2, src.close[k + 1]) if subject else None
            if src.at(brace) != "{":
                continue
            for a, arrow in _entries(src, brace + 1, src.close[brace]):
                labels.update(range(a, arrow))
                parts = [src.raw(x, y).strip() for x, y in src.split(a, arrow)]
                yield "case", src.tokens[a].line, "else" if parts == ["else"] else " | ".join(parts)
        elif word in ("is", "!is") and t.kind == "name" and not (k in labels and src.at(k - 1) in ("{", ",", "}", ";", "!")) and not (k in labels and src.tokens[k - 1].line < t.line):
            a = _operand_start(src, k - (2 if src.at(k - 1) == "!" else 1))
            yield from ((kind, src.tokens[a].line, src.raw(a, _type_end(src, k + 1))) for kind in ("is-true", "is-false"))
        elif word == "=" and src.is_name(k - 1) and src.at(k - 1) in tracked:
            before = src.at(k - 2)
            if before in _STATEMENT_START or before not in (".", "?.", "val", "var", "(", ",", ":") and src.tokens[k - 2].line < src.tokens[k - 1].line:
                yield f"write-{src.at(k - 1)}", src.tokens[k - 1].line, src.at(k - 1)


def legacy_rules(text: str, file_name: str, prefix: str | None = None, tracked: set[str] = frozenset(), entry_exit: bool = True) -> Iterator[RuleRow]:
    """(fqcn, method, rule kind, line, text) of a file's rules, in order."""
    package = _package(text)
    if prefix and package and not package.startswith(prefix):
        return
    src = Source(text)
    top = file_name.rsplit(".", 1)[0] + "Kt"
    for classes, name, first, end in functions(src):
        if classes is None:
            continue
        fqcn = ".".join(x for x in (package, "$".join(classes) or top) if x)
        if prefix and not fqcn.startswith(prefix):
            continue
        if entry_exit:
            yield fqcn, name, "enter", None, None
            yield fqcn, name, "exit", None, None
        for kind, line, shown in body_rules(src, first, end, set(tracked)):
            yield fqcn, name, kind, line, shown
