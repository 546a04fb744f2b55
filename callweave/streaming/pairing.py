"""Call pairing inside tasks: stretches of a trace are settled alone as far as that is certain.

A stretch knows nothing of calls opened before it. An exit whose method is open within
the stretch, with no unknown exit since, ends that call whatever came before; any other
exit is unknown and may give up all calls that stand open. What has been settled between
an enter and its exit leaves no trace outside, so stretches without it, put in a row,
pair as the whole trace does.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext

#: What tasks tell: pairs, pairs `inside` whose depth counts from line n of the block, lines left over, and sizes of the stack after those.
TOLD = "kind string, key {key}, block int, n long, method string, enter_seq {at}, exit_seq {at}, phase string, depth long"


class Call:
    """An open call: its enter, and the call it was made in (None if unknown)."""

    __slots__ = ("at", "method", "inside", "line")

    def __init__(self, at, method: str | None, inside: Call | None):
        self.at, self.method, self.inside, self.line = at, method, inside, None


def _last(stack: list[Call], method: str | None) -> int:
    """Place of the last open call of a method, -1 without one."""
    return next((k for k in range(len(stack) - 1, -1, -1) if stack[k].method == method), -1)


def whole(lines: list[tuple]) -> Iterator[tuple]:
    """(call, exit, phase, depth) of all enters of a whole trace (at, phase, method)."""
    stack: list[Call] = []
    for at, phase, method in lines:
        if phase == "enter":
            stack.append(Call(at, method, None))
        elif (k := _last(stack, method)) >= 0:
            yield from ((c, None, None, k + 2 + j) for j, c in enumerate(stack[k + 1 :]))
            yield stack[k], at, phase, k + 1
            del stack[k:]
    yield from ((c, None, None, j + 1) for j, c in enumerate(stack))


def stretch(lines: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """What a stretch settles, (call, exit, phase, line, depth from that line on), and the lines left over, after one that says where it begins."""
    stack: list[Call] = []
    ended: list[tuple] = []
    left = [(lines[0][0], "begin", None)]
    base: dict[int, int] = {}

    def leave() -> None:
        for call in stack:
            call.line = len(left)
            left.append((call.at, "enter", call.method))
        stack.clear()

    for at, phase, method in lines:
        if phase == "enter":
            call = Call(at, method, stack[-1] if stack else None)
            base[id(call)] = len(left) - 1
            stack.append(call)
        elif (k := _last(stack, method)) >= 0:
            ended += [(c, None, None, base.pop(id(c))) for c in stack[k + 1 :]]
            ended.append((stack[k], at, phase, base.pop(id(stack[k]))))
            del stack[k:]
        else:
            leave()
            left.append((at, phase, method))
    leave()
    return [(c, exit_at, phase, *_from(c, line)) for c, exit_at, phase, line in ended], left


def _from(call: Call, line: int) -> tuple[int, int]:
    """The line that was left over last before a call, and how much deeper the call is than the stack after it."""
    depth, inside = 1, call.inside
    while inside is not None and inside.line is None:
        depth, inside = depth + 1, inside.inside
    return (line if inside is None else inside.line), depth


def _batch(rows: list[tuple], key: pa.DataType, at: pa.DataType) -> pa.RecordBatch:
    types = [pa.string(), key, pa.int32(), pa.int64(), pa.string(), at, at, pa.string(), pa.int64()]
    names = ["kind", "key", "block", "n", "method", "enter_seq", "exit_seq", "phase", "depth"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _by_key(batches: Iterator[pa.RecordBatch], names: list[str], types: dict) -> Iterator[tuple]:
    """(key, lines) of rows sorted by key; types gets the columns' types."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            types.update({f.name: f.type for f in batch.schema})
            yield from zip(*(batch.column(c).to_pylist() for c in ["key", *names]), strict=True)

    for key, lines in groupby(rows(), key=lambda r: r[0]):
        yield key, (r[1:] for r in lines)


def settle_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's keys: those that begin and end in it are paired, of the first and the last what is certain."""
    block, types = TaskContext.get().partitionId(), {}

    def told(key, lines: list[tuple], inner: bool) -> list[tuple]:
        if inner:
            return [("pair", key, block, None, c.method, c.at, end, phase, depth) for c, end, phase, depth in whole(lines)]
        ended, left = stretch(lines)
        rows = [("inside", key, block, line, c.method, c.at, end, phase, depth) for c, end, phase, line, depth in ended]
        return rows + [("line", key, block, n, method, at, None, phase, None) for n, (at, phase, method) in enumerate(left)]

    first, before = True, None
    for key, lines in _by_key(batches, ["at", "phase", "method"], types):
        if before:
            yield _batch(told(*before, not first), types["key"], types["at"])
            first = False
        before = key, list(lines)
    if before:
        yield _batch(told(*before, False), types["key"], types["at"])


def settle_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines left over, in order by key: their pairs, and the size of the stack after each line."""
    types: dict = {}
    for key, lines in _by_key(batches, ["block", "n", "at", "phase", "method"], types):
        stack: list[Call] = []
        rows: list[tuple] = []
        for block, n, at, phase, method in lines:
            if phase == "enter":
                stack.append(Call(at, method, None))
            elif phase != "begin" and (k := _last(stack, method)) >= 0:
                rows += [("pair", key, None, None, c.method, c.at, None, None, k + 2 + j) for j, c in enumerate(stack[k + 1 :])]
                rows.append(("pair", key, None, None, method, stack[k].at, at, phase, k + 1))
                del stack[k:]
            rows.append(("size", key, block, n, None, None, None, None, len(stack)))
            if len(rows) >= 10_000:
                yield _batch(rows, types["key"], types["at"])
                rows = []
        rows += [("pair", key, None, None, c.method, c.at, None, None, j + 1) for j, c in enumerate(stack)]
        yield _batch(rows, types["key"], types["at"])
