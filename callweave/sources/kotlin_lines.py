"""Kotlin events over a table of files, inside the JVM and without a shuffle: each file's lines are an array.

1. Lines that change the depth of braces or begin a class or function are folded with
   the spans that are open: a fall of depth ends those that stand deeper.
2. Each function takes its own lines along, so all later work is on functions.
3. Conditions may go on over lines. A function's code is cut behind each parenthesis
   and folded with the parentheses that are open; what lies between two is joined.
4. Patterns find the other events line by line.

Rows are those of kotlin.scan(). Only idx, the number of an event in its file, takes a
window; where it is not asked for, nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.sources import files, kotlin

FIELDS = "language fqcn method signature kind line condition_text".split()


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _respaced(text: Column) -> Column:
    """Runs of white space as one space, or none beside punctuation and at the ends."""
    for pattern, put in ((r"(?U)^\s+|\s+$|(?<=[(\[])\s+|\s+(?=[.,)\]:;])", ""), (r"(?U)\s+", " ")):
        text = F.regexp_replace(text, pattern, put)
    return text


def _from(values: Column, first: Column, last: Column) -> Column:
    """Elements first to last, one at a time; slice() would copy the whole array for each part of it."""
    return F.transform(F.sequence(first, last), lambda k: F.element_at(values, k))


def _openers(piece: Column) -> Column:
    """The event kinds of a condition that opens at the end of a piece of code, null if none does."""
    kinds = F.when(piece.rlike(kotlin.IF.pattern + "$"), F.array(F.lit("if-true"), F.lit("if-false")))
    return kinds.when(piece.rlike(kotlin.WHEN.pattern + "$"), F.array(F.lit("switch")))


def _asked(lines: Column) -> Column:
    """Whether a condition begins in any of the lines."""
    return F.exists(lines, lambda c: c.rlike(f"{kotlin.IF.pattern}|{kotlin.WHEN.pattern}"))


def _still_open(code: Column) -> Column:
    """How many parentheses of a text no later one closes."""
    step = lambda n, c: F.when(c == "(", n + 1).when(c == ")", F.greatest(n - 1, F.lit(0))).otherwise(n)
    return F.aggregate(F.split(F.regexp_replace(code, "[^()]", ""), ""), F.lit(0), step)


def _pieces(lines: Column) -> Column:
    """The code of lines cut behind each parenthesis, with line and place in it."""
    cut = lambda code, row: F.transform(F.split(code, r"(?<=[()])", -1), lambda p, nth: F.struct(row.alias("row"), nth.alias("nth"), p.alias("piece")))
    return F.filter(F.flatten(F.transform(lines, cut)), lambda x: x["piece"] != "")


def _pairs(pieces: Column) -> Column:
    """(at, close) of conditions among pieces, by a fold that holds the places of open parentheses, the last one first."""
    none = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast("array<struct<at:int,close:int>>").alias("done"))
    signs = F.transform(pieces, lambda x, at: F.struct(at.alias("at"), F.right(x["piece"], F.lit(1)).alias("sign"), (_openers(x["piece"]).isNotNull()).alias("asked")))
    signs = F.filter(signs, lambda x: x["sign"].isin("(", ")"))

    def step(now: Column, x: Column) -> Column:
        # an opening that nobody asked about is held as its place below zero
        held, top = F.when(x["asked"], x["at"]).otherwise(-1 - x["at"]), F.try_element_at(now["open"], F.lit(1))
        opens = F.when(x["sign"] == "(", F.array_prepend(now["open"], held)).otherwise(F.slice(now["open"], F.lit(2), F.greatest(F.size(now["open"]) - 1, F.lit(0))))
        done = F.when((x["sign"] == ")") & (top >= 0), F.array_append(now["done"], F.struct(top.alias("at"), x["at"].alias("close")))).otherwise(now["done"])
        return F.struct(opens.alias("open"), done.alias("done"))

    return F.aggregate(signs, none, step, lambda x: x["done"])


def _condition(pieces: Column, pair: Column) -> Column:
    """(row, nth, kinds, shown) of one pair."""
    first = F.element_at(pieces, pair["at"] + 1)
    raw = F.array_join(F.transform(_from(pieces, pair["at"] + 2, pair["close"] + 1), lambda x: x["piece"]), "")
    return F.struct(first["row"].alias("row"), first["nth"].alias("nth"), _openers(first["piece"]).alias("kinds"), _respaced(F.left(raw, F.length(raw) - 1)).alias("shown"))


def _told(conditions: Column) -> Column:
    """Events of conditions that have a text."""
    event = lambda c: F.transform(c["kinds"], lambda kind, sub: F.struct(c["row"].alias("row"), F.when(F.size(c["kinds"]) == 2, 0).otherwise(1).alias("rank"), c["nth"].alias("nth"), sub.alias("sub"), kind.alias("kind"), c["shown"].alias("shown")))
    return F.flatten(F.transform(F.filter(conditions, lambda c: c["shown"] != ""), event))


def _found(line: Column, row: Column) -> Column:
    """(row, rank, nth, sub, kind, shown) of what patterns find in a line."""
    label = F.trim(F.regexp_replace(line, r"(?U)^\s+|\s+$", ""))
    named = F.when(F.instr(label, "->") > 1, F.regexp_replace(F.substring_index(label, "->", 1), r"(?U)\s+$", "")).otherwise(label)
    told = lambda rank, nth, kind, shown: F.struct(row.alias("row"), F.lit(rank).alias("rank"), nth.alias("nth"), F.lit(0).alias("sub"), F.lit(kind).alias("kind"), shown.alias("shown"))
    none, once = F.lit(None).cast("string"), F.lit(0)
    single = F.array_compact(
        F.array(
            F.when(line.rlike(kotlin.BARE_WHEN.pattern), told(2, once, "switch", none)),
            F.when(line.rlike(kotlin.ENTRY.pattern), told(3, once, "when-branch", named)),
            F.when(line.rlike(kotlin.RETURN.pattern), told(4, once, "return", none)),
            F.when(line.rlike(kotlin.THROW.pattern), told(5, once, "throw", F.regexp_replace(F.regexp_extract(line, kotlin.THROW.pattern, 1), r"(?U)^\s+|\s+$", ""))),
        )
    )
    writes = F.transform(F.regexp_extract_all(line, F.lit(kotlin.WRITE.pattern), F.lit(1)), lambda name, k: told(6, k, "write", name))
    return F.concat(single, writes)


def _all_found(rows: DataFrame, lines: str, reach: str) -> DataFrame:
    """rows with `x`, one for each event in `lines` (row, rank, nth, sub, kind, shown); conditions may end in `reach`, which begins with these lines."""
    rows = rows.withColumn("__pieces", F.when(_asked(F.col(lines)), _pieces(F.col(reach))))
    rows = rows.withColumn("__pairs", _pairs(F.col("__pieces")))
    told = _told(F.filter(F.transform("__pairs", lambda pair: _condition(F.col("__pieces"), pair)), lambda c: c["row"] < F.size(lines)))
    none = F.array().cast("array<struct<row:int,rank:int,nth:int,sub:int,kind:string,shown:string>>")
    found = F.concat(F.coalesce(told, none), F.flatten(F.transform(lines, _found)))
    return rows.withColumn("x", F.explode(found)).drop("__pieces", "__pairs")


def line_events(code: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, rank, nth, sub, kind, shown) of lines (keys, row, code): all that stands in them, in the order of the last four."""
    files_of = code.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row", "code"))).alias("__all"))
    lines = files_of.select(*keys, F.transform("__all", lambda x: x["row"]).alias("__rows"), F.transform("__all", lambda x: x["code"]).alias("__lines"))
    found = _all_found(lines, "__lines", "__lines")
    return found.select(*keys, F.element_at("__rows", F.col("x.row") + 1).alias("row"), "x.rank", "x.nth", "x.sub", "x.kind", "x.shown")


SPAN = "row:int,end:int,class:string,method:string,parameters:string"


def _spans(codes: Column) -> Column:
    """(row, end, class, method, parameters) of classes and functions in order; end is the first later line of smaller depth, null if none comes."""
    part = lambda c, p, k: F.when(c.rlike(p.pattern), F.regexp_extract(c, p.pattern, k))
    mark = lambda c, row: F.struct(row.alias("row"), (_count(c, "{") - _count(c, "}")).alias("step"), part(c, kotlin.CLASS, 1).alias("class"), part(c, kotlin.FUNCTION, 1).alias("method"), part(c, kotlin.FUNCTION, 2).alias("parameters"))
    begins = lambda m: m["class"].isNotNull() | m["method"].isNotNull()
    marks = F.filter(F.transform(codes, mark), lambda m: (m["step"] != 0) | begins(m))
    ended = lambda o, end: F.struct(o["row"].alias("row"), end.alias("end"), o["class"].alias("class"), o["method"].alias("method"), o["parameters"].alias("parameters"))
    none = F.struct(F.lit(0).alias("depth"), F.array().cast(f"array<struct<depth:int,{SPAN.replace('end:int,', '')}>>").alias("open"), F.array().cast(f"array<struct<{SPAN}>>").alias("done"))

    def step(now: Column, m: Column) -> Column:
        depth = now["depth"] + m["step"]
        opens = F.when(m["step"] < 0, F.filter(now["open"], lambda o: o["depth"] <= depth)).otherwise(now["open"])
        own = F.struct(depth.alias("depth"), m["row"].alias("row"), m["class"].alias("class"), m["method"].alias("method"), m["parameters"].alias("parameters"))
        over = F.filter(now["open"], lambda o: o["depth"] > depth)
        done = F.when((m["step"] < 0) & F.exists(now["open"], lambda o: o["depth"] > depth), F.concat(now["done"], F.transform(over, lambda o: ended(o, m["row"])))).otherwise(now["done"])
        return F.struct(depth.alias("depth"), F.when(begins(m), F.array_append(opens, own)).otherwise(opens).alias("open"), done.alias("done"))

    rest = lambda now: F.transform(now["open"], lambda o: ended(o, F.lit(None).cast("int")))
    return F.array_sort(F.aggregate(marks, none, step, lambda now: F.concat(now["done"], rest(now))))


def _outermost(functions: Column) -> Column:
    """Functions that do not begin in another's span or on the line that ends it."""
    none = F.struct(F.lit(-1).alias("last"), F.array().cast(f"array<struct<{SPAN}>>").alias("kept"))
    step = lambda now, f: F.struct(F.greatest(now["last"], f["end"]).alias("last"), F.when(now["last"] < f["row"], F.array_append(now["kept"], f)).otherwise(now["kept"]).alias("kept"))
    return F.aggregate(functions, none, step, lambda now: now["kept"])


def _signature(name: Column, parameters: Column) -> Column:
    """name(types): what follows the last colon of each parameter, Any where there is no type."""
    plain = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    kind = lambda p: F.when(F.contains(p, F.lit(":")) & ~p.endswith(":"), plain(F.substring_index(p, ":", -1))).when(p != "", "Any").otherwise("")
    types = F.filter(F.transform(F.split(parameters, ","), lambda p: kind(plain(p))), lambda t: t != "")
    return F.concat(name, F.lit("("), F.array_join(types, ","), F.lit(")"))


def events(sources: DataFrame, keys: list[str] = ("path",), include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """(language, fqcn, method, signature, kind, line, condition_text, keys, idx) of files (text, path, keys) in a chosen package; idx orders a file's events."""
    keys = list(keys)
    package = files.package_of(F.col("text"), "kotlin")
    begins = lambda names: F.exists(F.array(*map(F.lit, names)), lambda p: F.startswith(package, p))
    chosen = sources.where(begins(include)) if include else sources
    chosen = chosen.where(~begins(exclude)) if exclude else chosen
    top = F.concat(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", ""), F.lit("Kt"))
    # a last line that is empty holds nothing either way
    codes = F.transform(F.split("text", r"\r\n|\r|\n"), lambda line: F.substring_index(line, "//", 1))
    spans = chosen.select(*keys, package.alias("package"), top.alias("top"), codes.alias("codes")).withColumn("spans", _spans(F.col("codes")))
    last = F.size("codes") - 1
    heads = F.filter("spans", lambda x: x["method"].isNotNull())
    heads = F.transform(heads, lambda f: f.withField("end", F.coalesce(f["end"], last)))
    spans = spans.withColumns({"heads": _outermost(heads), "classes": F.filter("spans", lambda x: x["class"].isNotNull())})

    def taken(f: Column) -> Column:
        lines = _from(F.col("codes"), f["row"] + 1, f["end"] + 1)
        # a condition that the function's last line leaves open may end anywhere after it
        opens = (f["end"] < last) & _asked(lines) & (_still_open(F.array_join(lines, "")) > 0)
        rest = F.when(opens, _from(F.col("codes"), f["end"] + 2, last + 1)).otherwise(F.array().cast("array<string>"))
        around = F.filter("classes", lambda c: (c["row"] <= f["end"]) & (c["end"].isNull() | (f["row"] < c["end"])))
        return F.struct(f["row"].alias("first"), f["method"].alias("method"), f["parameters"].alias("parameters"), lines.alias("lines"), rest.alias("rest"), around.alias("classes"))

    each = spans.select(*keys, "package", "top", F.explode(F.transform("heads", taken)).alias("f"))
    each = each.select(*keys, "package", "top", "f.*", _signature(F.col("f.method"), F.col("f.parameters")).alias("signature"))
    found = _all_found(each.withColumn("reach", F.concat("lines", "rest")), "lines", "reach").withColumn("row", F.col("first") + F.col("x.row"))
    around = F.filter("classes", lambda c: (c["row"] <= F.col("row")) & (c["end"].isNull() | (F.col("row") < c["end"])))
    owner = F.coalesce(F.nullif(F.array_join(F.transform(around, lambda c: c["class"]), "$"), F.lit("")), "top")
    fqcn = F.when(F.col("package") != "", F.concat("package", F.lit("."), owner)).otherwise(owner)
    order = Window.partitionBy(*keys).orderBy("row", "x.rank", "x.nth", "x.sub")
    return found.withColumn("idx", F.row_number().over(order).cast("bigint") - 1).select(
        F.lit("kotlin").alias("language"),
        fqcn.alias("fqcn"),
        "method",
        "signature",
        "x.kind",
        (F.col("row") + 1).cast("int").alias("line"),
        F.col("x.shown").alias("condition_text"),
        *keys,
        "idx",
    )
