"""Source files made of the events table: what scanners find in them is known from the rows.

A file holds up to SPAN event ids of one user: a class with eight lines for each event,
and for Kotlin a function beside the class. In the lines @e is the event's id, @k its k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Event ids that one file may cover, so that no file grows with the table.
SPAN = 2_000

KOTLIN = {
    "view": """    fun m@e(a: Int, b: List<String>): Int {
        if (a > @k &&
            b.isEmpty()) { // note if (no)
            approved = @k
        } else {
            throw IllegalStateException("n@k")
        }
    }""",
    "signup": """    class N@e {
        fun go(k: String): String {
            return when (k) {
                "@k" -> "first"
                else -> "other"
            }
        }
    }""",
    "purchase": """    fun outer@e() {
        fun inner(p: Int) {
            if (p == @k) return
        }
        inner(@k)
        val y = @k
        return
    }""",
    "click": """    fun s@e() {
        when {
            a == @k -> b()
            else -> c()
        }
        // if (gone) throw X
        val t = if (z is T@k) 1 else 2
    }""",
    "error": """    fun g@e() {
        throw Oops("@k")
    }
    object O@e {
        fun h(v: Int) {
            approved = true
        }
    }""",
}

JAVA = {
    "view": """    int m@e(int a, List<String> b) {
        if (a > @k && b.isEmpty()) {
            x = @k;
        } else {
            throw new IllegalStateException("n@k");
        }
        return a;
    }""",
    "signup": """    static class N@e {
        String go(String k) {
            switch (k) {
                case "@k": return "first";
                default: return "other";
            }
        }
    }""",
    "purchase": """    void s@e() {
        // if (gone) throw new X();
        if (z) { run(); }
        int t = @k;
        do {
            if (i == @k) continue;
        } while (i++ < t);
    }""",
    "click": """    void c@e(String... names) {
        if (names == null) {
            return;
        } else if (names.length == @k) {
            go();
        }
        String q = "if (x) return";
    }""",
    "error": """    interface I@e {
        default int h(int v) {
            Runnable r = new Runnable() { public void run() { throw new Oops(@k); } };
            return v;
        }
    }
    enum E@e { A, B }
    // end""",
}

END = {"kotlin": "}\nfun top(v: Int) {\n    approved = v\n}\n", "java": "}\n"}


def _told(templates: dict[str, str], kind: Column, e: Column, k: Column) -> Column:
    text = None
    for name, template in templates.items():
        text = F.when(kind == name, template) if text is None else text.when(kind == name, template)
    return F.replace(F.replace(text, F.lit("@e"), e), F.lit("@k"), k)


def sources(events: DataFrame) -> DataFrame:
    """(language, path, text): a Kotlin and a Java file for each user and span of ids."""
    e, k = F.col("event_id").cast("string"), F.get_json_object("props", "$.k")
    frames = []
    for language, templates, suffix, end in (("kotlin", KOTLIN, "kt", ""), ("java", JAVA, "java", ";")):
        part = events.select("user_id", F.floor(F.col("event_id") / SPAN).alias("span"), "event_id", _told(templates, F.col("event_type"), e, k).alias("lines"))
        body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "lines"))), lambda x: x["lines"]), "\n")
        name = F.concat(F.lit("U"), "user_id", F.lit("x"), "span")
        head = F.concat(F.lit("package com.example.p"), F.col("user_id") % 3, F.lit(f"{end}\n\n{'public ' if end else ''}class "), name, F.lit(" {\n"))
        made = part.groupBy("user_id", "span").agg(body.alias("body"))
        frames.append(made.select(F.lit(language).alias("language"), F.concat(F.lit("/src/"), name, F.lit(f".{suffix}")).alias("path"), F.concat(head, "body", F.lit("\n" + END[language])).alias("text")))
    return frames[0].union(frames[1])
