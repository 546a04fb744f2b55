"""The predicate language: classify a condition, render it, translate it into helper calls.

Two grammars live side by side because results differ. classify() splits a text at
its top-level operators, and-operators first unless strict; translate() honours
precedence. DataFrame callers use condition_forms(), which parses each distinct text
once and leaves texts of simple shape to column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The runtime evaluator's class and the shapes of simple predicates.
EVALUATOR = "org.example.trace.SafeEval"
EQUALS = r"""^\s*([a-zA-Z_][\w.$]*)\s*==\s*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[A-Z_][A-Z0-9_]*|-?[0-9]+)\s*$"""
INSTANCE_OF = r"^\s*([a-zA-Z_][\w.$]*)\s+instanceof\s+([a-zA-Z_][\w.$]*)\s*$"

_EQUALS, _INSTANCE_OF = re.compile(EQUALS, re.A), re.compile(INSTANCE_OF, re.A)
_MARK = re.compile(r"\(|\)|&&|\|\|")


@dataclass(frozen=True)
class Predicate:
    """kind is equals, instanceof, and, or, original; parts are operand texts or, for and / or, predicates."""

    kind: str
    parts: tuple

    def inline(self) -> str:
        """The form that stands in a rule's guard."""
        if self.kind in ("and", "or"):
            out = self.parts[0].inline()
            for part in self.parts[1:]:
                out = f"({out}) {self.kind.upper()} ({part.inline()})"
            return out
        return {"equals": " == ", "instanceof": " instanceof "}.get(self.kind, "").join(self.parts)

    def helper(self, rule_id: str, evaluator: str = EVALUATOR) -> str:
        """The form that calls the evaluator."""
        if self.kind in ("and", "or"):
            out = self.parts[0].helper(rule_id, evaluator)
            for part in self.parts[1:]:
                out = f"{evaluator}.{self.kind}({out}, {part.helper(rule_id, evaluator)})"
            return out
        if self.kind == "equals":
            return f"{evaluator}.ifEq({self.parts[0]}, {self.parts[1]})"
        if self.kind == "instanceof":
            return f'{evaluator}.ifInstanceOf({self.parts[0]}, "{self.parts[1]}")'
        return f'{evaluator}.ifMatch("{rule_id}")'

    def guard(self, rule_id: str, safe: bool = False, force: bool = False, evaluator: str = EVALUATOR) -> str:
        """Inline unless safe mode asks for a call: always for originals, for the others only if forced."""
        return self.helper(rule_id, evaluator) if safe and (force or self.kind == "original") else self.inline()


def _unwrapped(text: str) -> str:
    """text without parentheses that enclose it as a whole."""
    out = text
    while len(out) > 1 and out[0] == "(" and out[-1] == ")":
        depth = 0
        for k, c in enumerate(out):
            depth += (c == "(") - (c == ")")
            if depth == 0:
                break
        if depth or k != len(out) - 1:
            break
        out = out[1:-1].strip()
    return out or text.strip()


def _top_level(text: str) -> dict[str, list[int]]:
    """Places of && and || outside parentheses."""
    found, depth = {"&&": [], "||": []}, 0
    for m in _MARK.finditer(text):
        if m[0] == "(":
            depth += 1
        elif m[0] == ")":
            depth = max(0, depth - 1)
        elif not depth:
            found[m[0]].append(m.start())
    return found


def classify(text: str | None, strict: bool = False) -> Predicate:
    """The predicate a condition text stands for; blank is `true`, unknown shapes pass through as they are.

    A composite with a part that passes through passes through as a whole. strict splits at || first and inside
    enclosing parentheses, as precedence asks."""
    if text is None or not text.strip():
        return Predicate("original", ("true",))
    whole, plain = text.strip(), _unwrapped(text.strip())
    marks = _top_level(plain if strict else whole)
    for sign, kind in (("||", "or"), ("&&", "and")) if strict else (("&&", "and"), ("||", "or")):
        if marks[sign]:
            body, cuts = plain if strict else whole, marks[sign]
            pieces = [body[a:b].strip() for a, b in zip([0, *(c + 2 for c in cuts)], [*cuts, len(body)], strict=True)]
            parts = tuple(classify(p, strict) for p in pieces)
            return Predicate("original", (text,)) if any(p.kind == "original" for p in parts) else Predicate(kind, parts)
    if m := _EQUALS.match(plain):
        return Predicate("equals", (m[1], m[2]))
    if m := _INSTANCE_OF.match(plain):
        return Predicate("instanceof", (m[1], m[2]))
    return Predicate("original", (text,))


class _Unsupported(Exception):
    pass


_OPERAND = re.compile(r"""(?P<quoted>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>-?\.*[0-9][0-9.]*)|(?P<name>[^\W\d][\w$.]*|\$[\w$.]*)""", re.S)
_TYPE = re.compile(r"(?:[^\W\d]|\$)[\w$.]*")
_BLANK = re.compile(r"\s*")
#: Binding power of the operators that join comparisons.
_JOINS = {"||": (1, "or"), "&&": (2, "and")}


class _Reader:
    """Precedence climbing over the text, by patterns anchored at the current place."""

    def __init__(self, text: str, evaluator: str) -> None:
        self.text, self.at, self.evaluator = text, 0, evaluator

    def skip(self) -> None:
        self.at = _BLANK.match(self.text, self.at).end()

    def take(self, token: str) -> bool:
        self.skip()
        if self.text.startswith(token, self.at):
            self.at += len(token)
            return True
        return False

    def expression(self, least: int = 1) -> str:
        out = self.comparison()
        while True:
            self.skip()
            power, name = _JOINS.get(self.text[self.at : self.at + 2], (0, ""))
            if power < least:
                return out
            self.at += 2
            out = f"{self.evaluator}.{name}({out}, {self.expression(power + 1)})"

    def comparison(self) -> str:
        if self.take("("):
            left = self.expression()
            if not self.take(")"):
                raise _Unsupported
        else:
            left = self.operand()
        if self.take("instanceof"):
            self.skip()
            m = _TYPE.match(self.text, self.at)
            if not m:
                raise _Unsupported
            self.at = m.end()
            return f'{self.evaluator}.ifInstanceOf({left}, "{m[0]}")'
        for sign, lead in (("==", ""), ("!=", "!")):
            if self.take(sign):
                return f"{lead}{self.evaluator}.ifEq({left}, {self.operand()})"
        return left

    def operand(self) -> str:
        self.skip()
        m = _OPERAND.match(self.text, self.at)
        if not m:
            raise _Unsupported
        self.at = m.end()
        if m["name"]:
            after = self.text[_BLANK.match(self.text, self.at).end() :][:1]
            if after in ("(", "["):
                raise _Unsupported
        return m[0]


def translate(text: str | None, evaluator: str = EVALUATOR) -> str:
    """The condition as evaluator calls; `true` if any of it is unsupported or nothing of it is a comparison."""
    if text is None or not text.strip():
        return "true"
    reader = _Reader(text, evaluator)
    try:
        out = reader.expression()
        reader.skip()
    except (_Unsupported, RecursionError):
        return "true"
    return out if reader.at >= len(text) and f"{evaluator}." in out else "true"


#: Stands for the rule id in a helper form; no condition can hold it.
ID_MARK = "\x00"
FORMS = "condition_text string, strategy_kind string, inline_form string, helper_form string, translated string"


def condition_forms(conditions: DataFrame, strict: bool = False, evaluator: str = EVALUATOR, own: Callable[[str], Predicate] | None = None) -> DataFrame:
    """(condition_text, strategy_kind, inline_form, helper_form, translated) of the distinct texts in conditions (condition_text)."""

    def parse(batches):
        for pdf in batches:
            found = [own(t) if own else classify(t, strict) for t in pdf["condition_text"]]
            yield pdf.assign(
                strategy_kind=[p.kind for p in found],
                inline_form=[p.inline() for p in found],
                helper_form=[p.helper(ID_MARK, evaluator) for p in found],
                translated=[translate(t, evaluator) for t in pdf["condition_text"]],
            )

    return conditions.where("condition_text is not null").select("condition_text").distinct().mapInPandas(parse, FORMS)


#: Stands for the evaluator's name, which may hold digits, while forms have shapes for operands.
EVALUATOR_MARK = "\x01"


def _filled(form: Column, numbers: Column) -> Column:
    """A shape's form with the numbers of a text in place of its zeros; forms hold all of them, in order, or none."""
    parts = F.split(form, "0")
    whole = F.array_join(F.transform(parts, lambda part, k: F.concat(part, F.coalesce(F.get(numbers, k), F.lit("")))), "")
    return F.when(F.contains(form, F.lit("0")), whole).otherwise(form)


def with_forms(rows: DataFrame, strict: bool = False, evaluator: str = EVALUATOR, few: bool = False) -> DataFrame:
    """rows (condition_text, ..) that have a condition, with the other columns of condition_forms().

    Both grammars take any run of digits like any other, so texts that differ only in digits have one shape, which is
    parsed once; rows are not joined by their texts. few tells that shapes are few at any number of rows: they are broadcast."""
    asked = rows.where("condition_text is not null").withColumn("__shape", F.regexp_replace("condition_text", "[0-9]+", "0"))
    forms = condition_forms(asked.select(F.col("__shape").alias("condition_text")), strict, EVALUATOR_MARK).withColumnRenamed("condition_text", "__shape")
    told = asked.join(F.broadcast(forms) if few else forms, "__shape").withColumn("__numbers", F.regexp_extract_all("condition_text", F.lit("[0-9]+"), F.lit(0)))
    made = {c: F.replace(_filled(F.col(c), F.col("__numbers")), F.lit(EVALUATOR_MARK), F.lit(evaluator)) for c in ("inline_form", "helper_form", "translated")}
    return told.withColumns(made).drop("__shape", "__numbers")


def is_simple(text: Column) -> Column:
    """Whether a text can be classified by patterns alone: no parentheses and no joining operators."""
    return ~text.rlike(r"[()]|&&|\|\|") & (F.length(F.trim(text)) > 0)


def simple_kind(text: Column) -> Column:
    return F.when(text.rlike(EQUALS), "equals").when(text.rlike(INSTANCE_OF), "instanceof").otherwise("original")


def simple_inline(text: Column) -> Column:
    """Predicate.inline() of a simple text."""
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    return (
        F.when(text.rlike(EQUALS), F.concat_ws(" == ", part(EQUALS, 1), part(EQUALS, 2)))
        .when(text.rlike(INSTANCE_OF), F.concat_ws(" instanceof ", part(INSTANCE_OF, 1), part(INSTANCE_OF, 2)))
        .otherwise(text)
    )


def simple_helper(text: Column, rule_id: Column, evaluator: str = EVALUATOR) -> Column:
    """Predicate.helper() of a simple text."""
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    return (
        F.when(text.rlike(EQUALS), F.concat(F.lit(f"{evaluator}.ifEq("), part(EQUALS, 1), F.lit(", "), part(EQUALS, 2), F.lit(")")))
        .when(text.rlike(INSTANCE_OF), F.concat(F.lit(f"{evaluator}.ifInstanceOf("), part(INSTANCE_OF, 1), F.lit(', "'), part(INSTANCE_OF, 2), F.lit('")')))
        .otherwise(F.concat(F.lit(f'{evaluator}.ifMatch("'), rule_id, F.lit('")')))
    )


def evaluated(translated: Column, values: dict[str, Column], instance: Column, evaluator: str = EVALUATOR) -> Column:
    """Whether translate()'s calls hold for a row: names have the values' text, and instance tests the answer `instance`.

    Comparisons become T or F, then calls of T and F are worked out from the innermost outward, as often as there are
    calls of and and or. A name without a value equals nothing, and a null value equals no literal; text that is only `true` holds."""
    out = F.replace(translated, F.lit(f"{evaluator}."), F.lit("@"))
    for name, value in values.items():
        for quote in ("", "'", '"'):
            same = F.concat(F.lit(f"@ifEq({name}, {quote}"), value, F.lit(f"{quote})"))
            out = F.replace(out, F.coalesce(same, F.lit(ID_MARK)), F.lit("T"))
    out = F.regexp_replace(out, r"""@ifEq\((?:[^()"']|"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')*\)""", "F")
    out = F.regexp_replace(out, r"@ifInstanceOf\([^()]*\)", F.when(instance, "T").otherwise("F"))
    out = F.replace(F.replace(out, F.lit("!T"), F.lit("F")), F.lit("!F"), F.lit("T"))

    def inner(text: Column, _: Column) -> Column:
        for calls, value in ((r"@and\(T, T\)|@or\((?:T, [TF]|F, T)\)", "T"), (r"@or\(F, F\)|@and\((?:F, [TF]|T, F)\)", "F")):
            text = F.regexp_replace(text, calls, value)
        return text

    # counted in the text itself, so that what stands above is worked out once
    calls = F.regexp_count(translated, F.lit(r"\.(?:and|or)\("))
    return F.when(calls == 0, out).otherwise(F.aggregate(F.sequence(F.lit(1), calls), out, inner)).isin("T", "true")
