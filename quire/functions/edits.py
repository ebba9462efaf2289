"""Edit scripts: minimal unit-cost edits between two texts as blocks.

Common ends are set aside. Between them a row of the distance table is two whole numbers, whose bits say where it rises and
where it falls, and a character of the source costs a few operations on them. The way back through the table divides it:
of a stretch of rows only the first rows of PART parts are held, and each part is made again, from the last on, when the
way has come to it. What is held grows with the target's length times the number of such levels, not with the table.

Texts that are alike do not need the table: with few edits beside the difference of their lengths, it is enough to know
how far each number of edits reaches on each diagonal that a script can touch. Longer ways are tried as long as that
is less work than the rows.

Of several minimal scripts the one is taken that, going back from the end, prefers a deletion, then an insertion, then a
match or replacement.
"""

from __future__ import annotations

from array import array

OPCODES = "array<struct<tag:string,src_start:int,src_end:int,dest_start:int,dest_end:int>>"
#: Rows that are held at each level.
PART = 64
NAMES = ("delete", "insert", "equal", "replace")
DELETE, INSERT, EQUAL, REPLACE = range(4)
#: What a row of the table costs in steps on diagonals, beside a part that grows with the target's length; and the most of
#: them, as each is held.
ROW_STEPS, MOST_STEPS = 4, 64


class Table:
    """The distances between all heads of two texts, of which nothing is held."""

    def __init__(self, source: str, target: str):
        self.source, self.target = source, target
        self.every = (1 << len(target)) - 1
        self.places: dict[str, int] = {}
        for k, c in enumerate(target):
            self.places[c] = self.places.get(c, 0) | 1 << k

    def after(self, row: tuple[int, int], c: str) -> tuple[tuple[int, int], int]:
        """The next row, for a character of the source, and where it lies above the ``row`` before."""
        rises, falls = row
        same = self.places.get(c, 0) | falls
        same |= (rises & same) + rises ^ rises
        up, down = falls | self.every & ~(rises | same), rises & same
        more, less = up << 1 | 1, down << 1
        return (self.every & (less | ~(more | same)), self.every & more & same), up

    def back(self, low: int, high: int, row: tuple[int, int], j: int, steps: list[int]) -> int:
        """Goes from (high, j) back to row ``low``, which is given; adds the steps, last first. Returns the column."""
        if high - low > PART:
            size = PART
            while size * PART < high - low:
                size *= PART
            firsts = [row]
            for k in range(low, low + (high - low - 1) // size * size):
                row = self.after(row, self.source[k])[0]
                if (k + 1 - low) % size == 0:
                    firsts.append(row)
            for k in range(len(firsts) - 1, -1, -1):
                j = self.back(low + k * size, min(high, low + (k + 1) * size), firsts.pop(), j, steps)
            return j
        rows = []
        for k in range(low, high):
            row, up = self.after(row, self.source[k])
            rows.append((row[0], up))
        for i in range(high, low, -1):
            rises, up = rows.pop()
            while j and not up >> j - 1 & 1 and rises >> j - 1 & 1:
                steps.append(INSERT)
                j -= 1
            if not j or up >> j - 1 & 1:
                steps.append(DELETE)
            else:
                steps.append(EQUAL if self.source[i - 1] == self.target[j - 1] else REPLACE)
                j -= 1
        return j

    def steps(self) -> list[int]:
        out: list[int] = []
        j = self.back(0, len(self.source), (self.every, 0), len(self.target), out)
        return [INSERT] * j + out[::-1]


def equal_run(source: str, target: str, i: int, j: int) -> int:
    """The number of characters from i and j on that are equal."""
    n, size = min(len(source) - i, len(target) - j), 16
    at = 0
    while at + size <= n and source[i + at : i + at + size] == target[j + at : j + at + size]:
        at += size
        size *= 2
    # the first difference is within the next ``size`` characters
    while size > 8:
        size //= 2
        if at + size <= n and source[i + at : i + at + size] == target[j + at : j + at + size]:
            at += size
    while at < n and source[i + at] == target[j + at]:
        at += 1
    return at


def near_script(source: str, target: str) -> list[tuple[int, int]] | None:
    """(step, times) of the script, last first; None if the texts are so unlike that the table is less work.

    ``far[e][k - low]`` is the last row on diagonal k (row - column) that e edits reach. A script of ``most`` edits touches
    after e of them only diagonals from which the others suffice for the way to the end.
    """
    goal, spare = len(source) - len(target), 1
    least = abs(goal)
    work = len(source) * min(MOST_STEPS, ROW_STEPS + len(target) // 512)
    while (least + 2 * spare) * (2 * spare + 1) <= work:
        most, far, lows = least + 2 * spare, [], []
        for e in range(most + 1):
            low, high = max(-e, goal - most + e, -len(target)), min(e, goal + most - e, len(source))
            row = array("q")
            before, back = (far[-1], lows[-1]) if e else (row, 0)
            for k in range(low, high + 1):
                i = 0 if e == 0 else -1
                at = k - back
                if 0 <= at < len(before):
                    i = before[at] + 1  # a replacement
                if 0 < at <= len(before):
                    i = max(i, before[at - 1] + 1)  # a deletion
                if -1 <= at < len(before) - 1:
                    i = max(i, before[at + 1])  # an insertion
                i = min(i, len(source), len(target) + k)
                row.append(i + equal_run(source, target, i, i - k))
            far.append(row)
            lows.append(low)
            if low <= goal <= high and row[goal - low] == len(source):
                return way_back(source, target, far, lows)
        spare *= 2
    return None


def way_back(source: str, target: str, far: list[array], lows: list[int]) -> list[tuple[int, int]]:
    """(step, times), last first. On a diagonal the way stays equal up to the first row from its end where one edit less
    reaches a neighbour of it."""
    def reached(e: int, k: int) -> int:
        return far[e][k - lows[e]] if 0 <= k - lows[e] < len(far[e]) else -2

    out: list[tuple[int, int]] = []
    e, i, k = len(far) - 1, len(source), len(source) - len(target)
    while e:
        delete, insert, replace = reached(e - 1, k - 1) + 1, reached(e - 1, k + 1), reached(e - 1, k) + 1
        row = min(i, max(delete, insert, replace))
        if row < i:
            out.append((EQUAL, i - row))
            i = row
        e -= 1
        if i <= delete:
            out.append((DELETE, 1))
            i, k = i - 1, k - 1
        elif i <= insert:
            out.append((INSERT, 1))
            k += 1
        else:
            out.append((REPLACE, 1))
            i -= 1
    out.append((EQUAL, i))
    return out


def opcodes(source: str, target: str) -> list[tuple[str, int, int, int, int]]:
    """(tag, source start, source end, target start, target end) of equal, replace, delete and insert blocks."""
    short, head = min(len(source), len(target)), equal_run(source, target, 0, 0)
    tail = min(short - head, equal_run(source[::-1], target[::-1], 0, 0))
    out: list[tuple[str, int, int, int, int]] = []

    def add(step: int, n: int) -> None:
        if n:
            i, j = n * (step != INSERT), n * (step != DELETE)
            s, t = (out[-1][2], out[-1][4]) if out else (0, 0)
            if out and out[-1][0] == NAMES[step]:
                out[-1] = (NAMES[step], out[-1][1], s + i, out[-1][3], t + j)
            else:
                out.append((NAMES[step], s, s + i, t, t + j))

    add(EQUAL, head)
    a, b = source[head : len(source) - tail], target[head : len(target) - tail]
    near = near_script(a, b)
    for step, n in ((s, 1) for s in Table(a, b).steps()) if near is None else reversed(near):
        add(step, n)
    add(EQUAL, tail)
    return out
