"""Hashes and identifiers that agree with the JVM's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF


def java_hash(text: Column) -> Column:
    """String.hashCode as an unsigned 32-bit value in a bigint: a fold over UTF-16 units.

    A code point above the basic plane counts as its two surrogates."""

    def step(acc: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        high, low = F.lit(0xD7C0) + F.shiftright(code, 10), F.lit(0xDC00) + code.bitwiseAND(0x3FF)
        pair = (((acc * 31 + high).bitwiseAND(MASK)) * 31 + low).bitwiseAND(MASK)
        return F.when(code < 0x10000, (acc * 31 + code).bitwiseAND(MASK)).otherwise(pair)

    chars = F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))
    return F.aggregate(chars, F.lit(0).cast("bigint"), step)


def stable_shard(key: Column, shards: int) -> Column:
    """0 .. shards - 1 from the key's hash; null keys and a single shard give 0."""
    if shards <= 1:
        return F.lit(0)
    return F.coalesce(java_hash(key).bitwiseAND(0x7FFFFFFF) % shards, F.lit(0)).cast("int")


def shard_key(fqcn: Column, method: Column, line: Column) -> Column:
    """class#method:line; a rule without a line trigger has line 0."""
    return F.concat(F.coalesce(fqcn, F.lit("")), F.lit("#"), F.coalesce(method, F.lit("")), F.lit(":"), F.coalesce(line.cast("string"), F.lit("0")))


def rule_id(fqcn: Column, method: Column, line: Column, expression: Column) -> Column:
    """Lower-case hex of the four hashes folded by 31 from 1; a null counts 0."""
    out = F.lit(1).cast("bigint")
    for part in (java_hash(fqcn), java_hash(method), line.cast("bigint").bitwiseAND(MASK), java_hash(expression)):
        out = (out * 31 + F.coalesce(part, F.lit(0))).bitwiseAND(MASK)
    return F.lower(F.hex(out))


def correlation_id(cid: Column) -> Column:
    """The id that is there, else a new one; blank counts as missing."""
    return F.when(F.length(F.trim(cid)) > 0, cid).otherwise(F.uuid())
