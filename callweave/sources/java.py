"""Java events and regex rules.

scan() reads declarations from tokens: methods of classes, interfaces, enums and
records at any depth, and the ifs, switches, entries, returns and throws inside them.
regex_rules() finds classes and methods by patterns over masked text; it covers
methods that scan() gives no event for.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

from callweave.sources.tokens import Source, tokens

Event = tuple[str, str, str, str, str, int, str | None]

#: Keywords by role.
TYPES = frozenset("class interface enum record".split())
MODIFIERS = frozenset("public protected private abstract final static strictfp synchronized native default sealed non transient volatile".split())
NO_TYPE = MODIFIERS | frozenset("new return throw else case assert yield do try finally instanceof import package throws extends implements".split())
BINARY = frozenset("== != && || + - * / % < > <= >= & | ^ ? : = += -= *= /= %= &= |= ^= -> ".split())
UNARY = frozenset("! ~ + - ++ --".split())

#: Patterns of the regex scanner, possessive where they could backtrack.
PACKAGE = re.compile(r"(?m)^\s*package\s+([a-zA-Z0-9_.]+)\s*;", re.A)
CLASS = re.compile(r"(?m)^\s*(?:@[\w$.]+(?:\([^)]*+\))?\s*)*(?:(?:\b(?:public|protected|private|abstract|final|static|strictfp|sealed)\b|non-sealed)\s+)*class\s+([A-Za-z0-9_]+)", re.A)
METHOD = re.compile(r"(?m)^\s*(?:@[\w$.]+(?:\([^)]*+\))?\s*)*(?:\b(?:public|protected|private|abstract|final|static|strictfp|synchronized|native|default)\b\s+)*(?:<[^>]*+>\s*)?[\w$<>\[\],.?\s]+\s+([a-zA-Z0-9_]+)\s*\(([^)]*+)\)\s*\{", re.A)
BRANCHES = (
    (re.compile(r"\bif\s*\(([^)]*+)\)", re.A), ("if-true", "if-false")),
    (re.compile(r"\bswitch\s*\(([^)]*+)\)", re.A), ("when",)),
    (re.compile(r"(?m)^[\t ]*(case\s+[^:]*+|default)\s*:", re.A), ("case",)),
)
STRING, CHARACTER = re.compile(r'"(?:[^"\\]|\\.)*"'), re.compile(r"'(?:[^'\\]|\\.)*'")
BLOCK, LINE = re.compile(r"/\*.*?\*/", re.S), re.compile(r"(?m)//.*?$")


# --- by tokens ------------------------------------------------------------------------------------


def printed(src: Source, first: int, end: int) -> str:
    """Tokens as an expression printer spaces them: operators spaced, calls, members and prefixes tight."""
    out, tight = [], True
    for k in range(first, end):
        t, before = src.tokens[k], src.at(k - 1) if k > first else ""
        operand_before = k > first and (src.tokens[k - 1].kind != "op" or before in (")", "]"))
        if t.kind == "op" and t.text in BINARY and operand_before:
            out.append(f" {t.text} ")
            tight = True
            continue
        if t.kind == "op":
            prefix = t.text in UNARY and not operand_before
            lead = "" if tight or t.text in ").,;[]::++--" or t.text == "(" else " "
            out.append(lead + t.text + (" " if t.text == "," else ""))
            tight = prefix or t.text in "([.::,!~@"
            if t.text in ("++", "--") and operand_before:
                tight = False
            if t.text == ")":
                tight = False
            continue
        out.append(t.text if tight else f" {t.text}")
        tight = False
    return "".join(out).strip()


def _after_statement(src: Source, k: int) -> int:
    """The place after the statement that begins at k; else-if chains are followed, not nested."""
    word = src.at(k)
    while word == "if" and src.at(k + 1) == "(":
        end = _after_statement(src, src.close[k + 1] + 1)
        if src.at(end) != "else":
            return end
        k = end + 1
        word = src.at(k)
    if word == "{":
        return src.close[k] + 1
    if word in ("for", "while", "synchronized", "switch") and src.at(k + 1) == "(":
        return _after_statement(src, src.close[k + 1] + 1)
    if word == "do":
        end = _after_statement(src, k + 1)
        return next((j + 1 for j in src.top(end, len(src.tokens)) if src.at(j) == ";"), len(src.tokens))
    if word == "try":
        k += 1
        k = src.close[k] + 1 if src.at(k) == "(" else k
        k = _after_statement(src, k)
        while src.at(k) in ("catch", "finally"):
            k = _after_statement(src, src.close[k + 1] + 1 if src.at(k) == "catch" else k + 1)
        return k
    if src.is_name(k) and src.at(k + 1) == ":" and word != "default":
        return _after_statement(src, k + 2)
    for j in src.top(k, len(src.tokens)):
        if src.at(j) == ";":
            return j + 1
        if src.at(j) == "}":
            return j
    return len(src.tokens)


def _body_events(src: Source, first: int, end: int) -> Iterator[tuple[str, int, str | None]]:
    """(kind, line, text) inside a method: ifs with the rest of their chains, switches, entries, returns, throws."""
    words = {w: [k for k in range(first, end) if src.tokens[k].kind == "name" and src.at(k) == w] for w in ("if", "switch", "return", "throw")}
    for k in words["if"]:
        while src.at(k) == "if" and src.at(k + 1) == "(":
            close = src.close[k + 1]
            text, line = printed(src, k + 2, close), src.tokens[min(k + 2, len(src.tokens) - 1)].line
            yield "if-true", line, text
            k = _after_statement(src, close + 1)
            if src.at(k) != "else":
                break
            yield "if-false", line, text
            k += 1
    switches = [k for k in words["switch"] if src.at(k + 1) == "(" and src.at(src.close[k + 1] + 1) == "{"]
    for k in switches:
        if src.at(k - 1) in ("{", "}", ";", ")", "else", "do", ":"):
            yield "switch", src.tokens[k + 2].line, printed(src, k + 2, src.close[k + 1])
    entries = []
    for k in switches:
        body = src.close[k + 1] + 1
        for j in src.top(body + 1, src.close[body]):
            if src.at(j) == "default" and src.at(j + 1) in (":", "->"):
                entries.append((j, "default"))
            elif src.at(j) == "case":
                stop = next((x for x in src.top(j + 1, src.close[body]) if src.at(x) in (":", "->")), src.close[body])
                entries.append((j, "case " + " | ".join(printed(src, a, b) for a, b in src.split(j + 1, stop))))
    for j, label in sorted(entries):
        yield "switch-case", src.tokens[j].line, label
    for k in words["return"]:
        yield "return", src.tokens[k].line, None
    for k in words["throw"]:
        stop = next((j for j in src.top(k + 1, end) if src.at(j) == ";"), end)
        yield "throw", src.tokens[k].line, printed(src, k + 1, stop)


def _parameter_type(src: Source, first: int, end: int) -> str:
    """A parameter's type: its tokens without annotations, `final` and the name."""
    words, k = [], first
    while k < end - 1:
        if src.at(k) == "@":
            k += 2
            k = src.close[k] + 1 if src.at(k) == "(" else k
            continue
        if src.at(k) != "final":
            words.append(", " if src.at(k) == "," else src.at(k))
        k += 1
    return "".join(words)


def methods(src: Source) -> Iterator[tuple[str, str, str, int, int]]:
    """(type path, name, signature, first, end) of method bodies, outer before inner."""
    frames: list[tuple[str, int, str]] = []  # kind, closing place, name
    named: dict[int, str] = {}  # opening brace of a type -> its name
    for k, t in enumerate(src.tokens):
        while frames and k >= frames[-1][1]:
            frames.pop()
        if t.kind == "name" and t.text in TYPES and src.is_name(k + 1) and src.at(k - 1) != "." and (t.text != "record" or src.at(k + 2) in ("(", "<")):
            brace = next((j for j in src.top(k + 2, len(src.tokens)) if src.at(j) in ("{", ";")), None)
            if brace is not None and src.at(brace) == "{":
                named[brace] = src.at(k + 1)
        elif t.text == "{" and t.kind == "op":
            if k in named:
                frames.append(("type", src.close[k], named[k]))
            elif _opens_anonymous(src, k, frames):
                frames.append(("type", src.close[k], ""))
            else:
                frames.append(("block", src.close[k], ""))
        elif t.kind == "name" and src.at(k + 1) == "(" and frames and frames[-1][0] == "type" and _ends_type(src, k - 1):
            after = src.close[k + 1] + 1
            brace = next((j for j in range(after, len(src.tokens)) if src.at(j) in ("{", ";", "}", "=")), None)
            path = "$".join(name for kind, _, name in frames if kind == "type" and name)
            if brace is not None and src.at(brace) == "{" and path:
                types = [_parameter_type(src, a, b) for a, b in _parameters(src, k + 2, src.close[k + 1])]
                yield path, t.text, f"{t.text}({', '.join(types)})", brace, src.close[brace] + 1


def _parameters(src: Source, first: int, end: int) -> list[tuple[int, int]]:
    """Ranges between commas that stand outside brackets and type arguments."""
    out, depth, start = [], 0, first
    for k in src.top(first, end):
        depth += {"<": 1, ">": -1}.get(src.at(k), 0)
        if src.at(k) == "," and not depth:
            out.append((start, k))
            start = k + 1
    return [(a, b) for a, b in [*out, (start, end)] if a < b]


def _ends_type(src: Source, k: int) -> bool:
    return src.is_name(k) and src.at(k) not in NO_TYPE and src.at(k) not in TYPES and src.at(k - 1) not in ("@", "new") or src.at(k) in (">", "]")


def _opens_anonymous(src: Source, k: int, frames: list) -> bool:
    """Whether the brace at k begins the body of `new X(..)` or of an enum constant."""
    if src.at(k - 1) == ")":
        j = src.open.get(k - 1, 0) - 1
    else:
        j = k - 1
    depth = 0
    while j >= 0 and (src.is_name(j) and src.at(j) != "new" or src.at(j) in (".", "<", ">", ",", "?", "[", "]") and depth >= 0):
        if src.is_name(j) and src.at(j - 1) not in (".", "new", "<", ",", "?") and src.at(j + 1) != "<":
            break
        j -= 1
    if src.at(j) == "new" or src.at(j - 1) == "new":
        return True
    return bool(frames) and frames[-1][0] == "type" and src.is_name(k - 1 if src.at(k - 1) != ")" else j) and src.at(j - 1) in ("{", ",", "}")


def package_name(text: str) -> str:
    """What follows the first `package` up to a semicolon; no token after that is read."""
    found = tokens(text)
    if not any(t.text == "package" and t.kind == "name" for t in found):
        return ""
    words = []
    for t in found:
        if t.text == ";":
            return "".join(words)
        words.append(t.text)
    return ""


def scan(text: str, file_name: str = "", include: list[str] = (), exclude: list[str] = ()) -> Iterator[Event]:
    """Events (language, fqcn, method, signature, kind, line, condition_text) of a file in a chosen package."""
    package = package_name(text)
    if include and not package.startswith(tuple(include)) or exclude and package.startswith(tuple(exclude)):
        return
    src = Source(text)
    for path, name, signature, first, end in methods(src):
        fqcn = f"{package}.{path}" if package else path
        for kind, line, inner in _body_events(src, first, end):
            yield "java", fqcn, name, signature, kind, line, inner


# --- by patterns ----------------------------------------------------------------------------------


def mask(text: str) -> str:
    """Literals, then comments, as blanks of the same length; comments keep their line ends."""
    literal = lambda m: m[0][0] + " " * (len(m[0]) - 2) + m[0][0]
    comment = lambda m: re.sub(r"[^\n]", " ", m[0])
    for pattern, blank in ((STRING, literal), (CHARACTER, literal), (BLOCK, comment), (LINE, comment)):
        text = pattern.sub(blank, text)
    return text


def matching_brace(text: str, start: int) -> int:
    """The place of the brace that closes the one at start; the last place if none does."""
    depth = 0
    for m in re.compile(r"[{}]").finditer(text, start):
        depth += 1 if m[0] == "{" else -1
        if not depth:
            return m.start()
    return len(text) - 1


def _classes(masked: str, nested: bool) -> Iterator[tuple[str, int, int]]:
    """(qualified name, opening brace, closing brace); nested ones only if asked for, by their simple name."""
    m = PACKAGE.search(masked)
    package, at = (m[1] + "." if m else ""), 0
    while m := CLASS.search(masked, at):
        at, start = m.end(), masked.find("{", m.end())
        if start < 0:
            continue
        end = matching_brace(masked, start)
        yield package + m[1], start, end
        at = at if nested else end + 1


def declared_methods(text: str) -> set[tuple[str, str]]:
    """(class, method) that the patterns find in top-level classes."""
    masked = mask(text)
    return {(fqcn, m[1]) for fqcn, a, b in _classes(masked, False) for m in METHOD.finditer(masked[a + 1 : b])}


def _bodies(masked: str) -> list[tuple[str, str, int, int]]:
    """(class, method, first, end) of method bodies, those of a nested class under every class that holds it."""
    spans = [(fqcn, m[1], masked.find("{", a + 1 + m.start())) for fqcn, a, b in _classes(masked, True) for m in METHOD.finditer(masked[a + 1 : b])]
    return [(fqcn, method, brace + 1, matching_brace(masked, brace)) for fqcn, method, brace in spans if brace >= 0]


def _branches(masked: str, first: int, end: int) -> Iterator[tuple[tuple[str, ...], int, int, int]]:
    """(rule kinds, place, first, end of the text shown) of the branches in a stretch, pattern by pattern."""
    for pattern, kinds in BRANCHES:
        for m in pattern.finditer(masked[first:end]):
            yield kinds, first + m.start(), first + m.start(1), first + m.end(1)


def regex_rules(text: str, package_prefix: str | None = None, entry_exit: bool = True) -> Iterator[tuple[str, str, str, int | None, str | None]]:
    """(fqcn, method, rule kind, line, text) of the rules that the patterns give, in their order."""
    masked = mask(text)
    package = PACKAGE.search(masked)
    if package and package_prefix and package_prefix.strip() and not package[1].startswith(package_prefix):
        return
    starts = [0, *(m.end() for m in re.finditer("\n", text))]
    ends = [("enter", None, None), ("exit", None, None)] if entry_exit else []
    for fqcn, method, first, end in _bodies(masked):
        rows = list(ends)
        for kinds, at, a, b in _branches(masked, first, end):
            shown = " ".join(text[a:b].split()) if kinds == ("case",) else text[a:b]
            rows += [(kind, bisect_right(starts, at), shown) for kind in kinds]
        yield from ((fqcn, method, *row) for row in rows)
