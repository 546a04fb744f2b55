"""Small source files and conditions that queries and tests share."""

from __future__ import annotations

KOTLIN = """package com.example.flow

class Approval {
    fun decide(amount: Int, name: String): String {
        if (amount > 0 &&
            amount < 10) {
            approved = true
        } else {
            throw IllegalArgumentException("amount")
        }
        return when (name
            .trim().lowercase()) {
            "a" -> "first"
            else -> "other"
        }
    }
}
"""

JAVA = """package com.example.flow;

public class Mode {
    int pick(int mode) {
        if (mode>1) { return 1; } else { throw new IllegalStateException("no"); }
    }
    void run(String k) {
        switch (k) {
            case "a": break;
            default: return;
        }
    }
}
"""

#: (language, path, text)
SOURCES = [("kotlin", "/src/Approval.kt", KOTLIN), ("java", "/src/Mode.java", JAVA)]

CONDITIONS = ["a == 1", "(a == 1)", "x instanceof p.Type", "a == 1 && b == 2 || c == 'q'", "value != null", "f(x) == 1", "flag", "a == 1 || (b != -2.5 && x instanceof T)", "name == \"x && y\"", "LIMIT == MAX_VALUE"]
