"""Events to rules.

A rule stays columnar until its text is rendered. One pass over the events, flagged
by method, explodes each into the rules it stands for: enter and exit at a method's
first event, a switch for an orphan branch, and the event's own rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import ids, predicates, text
from callweave.operators import events as ev

#: Fixed value: what a `when` without subject shows as its selector.
NO_SUBJECT = "when { … }"
#: Own rule kind by language and event kind; other events have no rule of their own.
RULE_KINDS = {
    ("java", "if-true"): "if-true",
    ("java", "if-false"): "if-false",
    ("java", "switch"): "when",
    ("java", "switch-case"): "case",
    ("kotlin", "if-true"): "if-true",
    ("kotlin", "if-false"): "if-false",
    ("kotlin", "switch"): "when",
    ("kotlin", "when-branch"): "case",
    ("kotlin", "write"): "write",
}


@dataclass(frozen=True)
class Style:
    """What rule texts depend on; classify takes the place of the built-in classification if given."""

    helper: str = "trace.Helper"
    entry_exit: bool = True
    max_string_length: int = 0
    safe_mode: bool = False
    force_helper: bool = False
    evaluator: str = predicates.EVALUATOR
    strict: bool = False
    classify: Callable[[str], predicates.Predicate] | None = None


def rule_kind(language: Column, kind: Column) -> Column:
    """The kind of an event's own rule, null where it has none."""
    out = None
    for (lang, of), rule in RULE_KINDS.items():
        here = (language == lang) & (kind == of)
        out = F.when(here, rule) if out is None else out.when(here, rule)
    return out


def with_guards(events: DataFrame, style: Style) -> DataFrame:
    """events with rule_id, guard and registered, the translated evaluator body where the guard asks for one.

    Java conditions stand as they are. Kotlin conditions of simple shape are rendered by column expressions;
    the distinct others are parsed once each and joined back to their rows."""
    cond = F.coalesce("condition_text", F.lit("true"))
    identified = events.withColumn("rule_id", ids.rule_id(F.col("fqcn"), F.col("method"), F.col("line"), cond))
    branch = F.col("kind").isin("if-true", "if-false")
    kotlin = branch & (F.col("language") == "kotlin")

    def parsed(text: Column) -> Column:
        return F.lit(style.classify is not None) | ~predicates.is_simple(text) | (F.lit(style.safe_mode) & (predicates.simple_kind(text) == "original"))

    conditions = events.where(kotlin).select(cond.alias("condition_text")).where(parsed(F.col("condition_text")))
    forms = predicates.condition_forms(conditions, style.strict, style.evaluator, style.classify)
    forms = forms.select(F.col("condition_text").alias("__text"), "strategy_kind", "inline_form", "helper_form", F.col("translated").alias("__body"))
    hard = F.coalesce(kotlin & parsed(cond), F.lit(False))
    # only rows whose condition needs the parser are moved to it; the others stay where they are
    tough = identified.where(hard).join(forms, cond == F.col("__text"), "left")
    empty = {name: F.lit(None).cast("string") for name in forms.columns}
    joined = identified.where(~hard).withColumns(empty).unionByName(tough)
    kind = F.when(hard, F.col("strategy_kind")).otherwise(predicates.simple_kind(cond))
    inline = F.when(hard, F.col("inline_form")).otherwise(predicates.simple_inline(cond))
    called = F.when(hard, F.replace(F.col("helper_form"), F.lit(predicates.ID_MARK), F.col("rule_id"))).otherwise(predicates.simple_helper(cond, F.col("rule_id"), style.evaluator))
    safe = F.lit(style.safe_mode) & (F.lit(style.force_helper) | (kind == "original"))
    guard = F.when(kotlin, F.when(safe, called).otherwise(inline)).when(branch, cond)
    own = F.concat(F.lit(f'{style.evaluator}.ifMatch("'), F.col("rule_id"), F.lit('")'))
    out = joined.withColumn("guard", guard).withColumn("registered", F.when(kotlin & (F.col("guard") == own), F.coalesce("__body", F.lit("true"))))
    return out.drop("__text", "strategy_kind", "inline_form", "helper_form", "__body")


def _literal(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def to_rules(events: DataFrame, style: Style = Style()) -> DataFrame:
    """The rules of events, in columns and as text; `sub` orders the rules of one event."""
    flagged = ev.with_method_flags(with_guards(events, style))
    own = rule_kind(F.col("language"), F.col("kind"))
    wanted = F.array(
        F.when(F.col("is_first") & F.lit(style.entry_exit), F.struct(F.lit(0).alias("sub"), F.lit("enter").alias("rule_kind"))),
        F.when(F.col("is_first") & F.lit(style.entry_exit), F.struct(F.lit(1).alias("sub"), F.lit("exit").alias("rule_kind"))),
        F.when(F.col("is_orphan"), F.struct(F.lit(2).alias("sub"), F.lit("synthetic").alias("rule_kind"))),
        F.when(own.isNotNull(), F.struct(F.lit(3).alias("sub"), own.alias("rule_kind"))),
    )
    each = flagged.withColumn("rule", F.explode(F.array_compact(wanted))).withColumns({"sub": F.col("rule.sub"), "made": F.col("rule.rule_kind")}).drop("rule")
    place = F.struct(F.lit(0).alias("part"), "language", "fqcn", "method", F.col("line").cast("bigint").alias("line"), "kind", "scan_seq", "sub")
    return shape(each.withColumn("place", place), style)


def from_rows(rows: DataFrame, style: Style, part: int) -> DataFrame:
    """Rules from rows (language, fqcn, method, rule_kind, line, condition_text, path, idx) that a scanner gave as rules.

    Kotlin conditions are guarded like those of events; `part` places the rules after those of other parts."""
    kind = F.col("rule_kind")
    plain = rows.withColumn("made", F.when(F.startswith(kind, F.lit("write-")), "write").otherwise(kind)).withColumn("signature", F.lit(None).cast("string"))
    guarded = with_guards(plain.withColumn("kind", F.regexp_replace("made", "^is-", "if-")), style)
    place = F.struct(
        F.lit(part).alias("part"), "language", F.col("path").alias("fqcn"), F.lit("").alias("method"), F.col("idx").alias("line"), F.lit("").alias("kind"), F.lit("").alias("scan_seq"), F.lit(0).alias("sub")
    )
    return shape(guarded.withColumn("place", place), style)


def shape(each: DataFrame, style: Style) -> DataFrame:
    """Rule columns and text of rows (language, fqcn, method, signature, line, condition_text, made, guard, registered, rule_id, place)."""
    made, cond = F.col("made"), F.col("condition_text")
    at_method, branch = made.isin("enter", "exit"), made.rlike("^(if|is)-")
    blank = F.coalesce(F.trim(cond), F.lit("")) == ""
    shown = (
        F.when((made == "synthetic") | (made == "when") & (F.col("language") == "kotlin") & blank, F.lit(NO_SUBJECT))
        .when(made == "when", F.coalesce(cond, F.lit("")))
        .when(made == "case", F.coalesce(cond, F.when(F.col("language") == "java", "default").otherwise("else")))
        .when(branch, F.coalesce(cond, F.lit("true")))
        .otherwise(cond)
    )
    suffix = F.when(made == "synthetic", "when").when(made == "write", F.concat(F.lit("write-"), cond)).otherwise(made)
    line = F.col("line").cast("string")
    name = F.when(at_method, F.concat(made, F.lit("@"), F.col("fqcn"), F.lit("."), F.col("method"))).otherwise(F.concat(F.col("fqcn"), F.lit("."), F.col("method"), F.lit(":"), line, F.lit(":"), suffix))
    trigger = F.when(made == "enter", "AT ENTRY").when(made == "exit", "AT EXIT").when(made == "write", F.concat(F.lit("AFTER WRITE $"), cond)).otherwise(F.concat(F.lit("AT LINE "), line))
    positive = made.endswith("-true")
    check = F.when(branch, F.when(positive, F.concat(F.lit("IF ("), F.col("guard"), F.lit(")"))).otherwise(F.concat(F.lit("IF (!("), F.col("guard"), F.lit("))"))))
    evaluator = style.evaluator
    registration = F.when(
        branch & F.col("registered").isNotNull(),
        F.concat(
            F.lit(f'DO {evaluator}.register("'), F.col("rule_id"), F.lit(f'", new {evaluator}.Evaluator() {{\n    public boolean eval() {{\n        return '), F.col("registered"), F.lit(";\n    }\n});"),
        ),
    )
    call = F.when(made.isin("enter", "exit"), made).when(branch, "iff").when(made == "case", "kase").when(made == "write", "writeVar").otherwise("sw")
    where = F.concat(F.lit("DO "), call, F.lit("("), _literal(F.col("fqcn")), F.lit(","), _literal(F.col("method")), F.lit(","))
    escaped = _literal(text.escape(shown, style.max_string_length))
    end = F.when(branch, F.concat(F.lit(", "), positive.cast("string"), F.lit(")"))).when(made == "write", F.concat(F.lit(", $"), cond, F.lit(")"))).otherwise(F.lit(")"))
    action = F.when(at_method, F.concat(where, F.lit(" $LINE)"))).otherwise(F.concat(where, line, F.lit(","), escaped, end))
    at_line = F.when(~at_method & (made != "write"), F.col("line"))
    out = each.select(
        *ev.METHOD,
        F.when(~at_method, F.col("line")).alias("line"),
        suffix.alias("rule_kind"),
        trigger.alias("trigger"),
        check.alias("check"),
        registration.alias("registration"),
        action.alias("action"),
        name.alias("rule_name"),
        F.when(~at_method, F.concat(F.col("fqcn"), F.lit("."), F.col("method"))).alias("method_key"),
        ids.shard_key(F.col("fqcn"), F.col("method"), at_line).alias("shard_key"),
        "place",
    )
    return out.withColumn("rule_text", render(style.helper))


def render(helper: str) -> Column:
    """A rule's text from its columns; absent parts have no line."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("RULE "), F.col("rule_name")),
        F.concat(F.lit("CLASS "), F.col("fqcn")),
        F.concat(F.lit("METHOD "), F.col("method"), F.lit("(..)")),
        F.lit(f"HELPER {helper}"),
        F.col("trigger"),
        F.col("check"),
        F.col("registration"),
        F.col("action"),
        F.lit("ENDRULE"),
    )


def header(generator: str, helper: str, prefixes: list[str], tracked: list[str], timestamp: str | None = None, spaced: bool = True) -> str:
    """The comment lines that each output file begins with."""
    lines = [f"# Generated at {timestamp} by {generator}" if timestamp else f"# Generated by {generator}", f"# Helper: {helper}"]
    lines += [""] if spaced else []
    lines += [f"# Package prefix filters: {', '.join(prefixes)}"] if prefixes else []
    lines += [f"# Tracked variables: {', '.join(tracked)}"] if tracked else []
    return "\n".join(lines) + "\n"
