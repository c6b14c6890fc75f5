"""What trigrams a text must hold to match a regular expression.

The expression's syntax tree is walked from left to right with the set of
strings that may have been read since the last place where anything could stand.
At such a place (an open class, a repetition without end) that set becomes one
demand: some string of it is in the text, so all trigrams of one of them are.
"""

from __future__ import annotations

from re import _constants as ops
from re import _parser as tree

#: At most so many strings are followed at once; beyond, the set becomes a demand and a new one begins.
_MOST = 64

Demand = frozenset[frozenset[str]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def demand(strings: set[str]) -> Demand | None:
    """Some string of ``strings``, as sets of trigrams of which one must be there whole; None if a string has no trigram."""
    sets = {trigrams(s) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _letters(items: list) -> set[str] | None:
    """The characters of a class in small letters, None if there are more than eight, any, or some outside ASCII."""
    out = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(value)
        elif op is ops.RANGE and value[1] - value[0] < 16:
            out |= set(range(value[0], value[1] + 1))
        else:
            return None
    found = {chr(c).lower() for c in out}
    return found if len(found) <= 8 and max(out) < 128 else None


def _exact(nodes) -> set[str] | None:
    """All strings that ``nodes`` match, in small letters; None if they are many or without end."""
    out = {""}
    for op, value in nodes:
        more: set[str] | None = None
        if op is ops.LITERAL:
            more = {chr(value).lower()} if value < 128 else None
        elif op is ops.IN:
            more = _letters(value)
        elif op is ops.AT:
            more = {""}
        elif op is ops.SUBPATTERN:
            more = _exact(value[-1])
        elif op is ops.BRANCH:
            parts = [_exact(branch) for branch in value[1]]
            more = None if None in parts else set().union(*parts)
        elif op is ops.MAX_REPEAT and value[1] <= 8:
            once = _exact(value[2])
            if once is not None and len(once) ** int(value[1]) <= _MOST:
                more, step = set(), {""}
                for n in range(int(value[1]) + 1):
                    more |= step if n >= value[0] else set()
                    step = {a + b for a in step for b in once}
        if more is None or len(out) * len(more) > _MOST:
            return None
        out = {a + b for a in out for b in more}
    return out


def required(pattern: str) -> list[Demand]:
    """Demands that every text matching ``pattern`` meets, in small letters; an empty list if there are none.

    Each demand is a set of alternatives, each alternative a set of trigrams.
    """
    found: list[Demand] = []

    def flush(run: set[str]) -> set[str]:
        what = demand(run)
        if what and what not in found:
            found.append(what)
        return {""}

    def walk(nodes, run: set[str]) -> set[str]:
        for op, value in nodes:
            more = _exact([(op, value)])
            if more is not None and len(run) * len(more) <= _MOST:
                run = {a + b for a in run for b in more}
            elif more is not None:
                flush(run)
                run = more
            elif op is ops.SUBPATTERN:
                run = walk(value[-1], run)
            elif op is ops.MAX_REPEAT and value[0] >= 1:
                # The first of several: what follows it is open.
                run = flush(walk(value[2], run))
            else:
                run = flush(run)
        return run

    flush(walk(tree.parse(pattern), {""}))
    return found
