"""Knuth's lightest derivations over a chain of edits.

Items are (step, state): so many steps are dealt with and the output is in that state. The
deductions are hyperedges with two antecedents, an item and an edit of the next step that fits
its state, or one antecedent for an insertion. The weight of a conclusion is the superior
function (cost + cost of the edit, audit + letters of the edit) of those of its antecedents:
never lighter than either, and monotone, since two audits of one item use up the same steps and
so are never one the beginning of the other at equal cost. So the agenda may pop the lightest
item and finalise it, as in Dijkstra's shortest paths, and stop once a goal item is final.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from heapq import heappop, heappush

#: From state, to state, cost, letters.
Edit = tuple[int, int, int, str]
Weight = tuple[int, str]


def lightest(
    steps: Sequence[Iterable[Edit]],
    inserts: Iterable[Edit] = (),
    start: int = 0,
    goal: Collection[int] | None = None,
    insert_last: bool = True,
) -> dict[int, Weight]:
    """The lightest (cost, audit) of each state after all steps, ties to the least audit.

    With ``goal``, only the lightest of these states. Insertions may come before any step, and
    after the last one if ``insert_last``.
    """
    n = len(steps)
    added: dict[int, list[Edit]] = {}
    for edit in inserts:
        added.setdefault(edit[0], []).append(edit)
    fitting: list[dict[int, list[Edit]] | None] = [None] * n
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == n:
            if goal is None or state in goal:
                found[state] = (cost, audit)
                if goal is not None:
                    return found
            if not insert_last:
                continue
        elif fitting[at] is None:
            by_state: dict[int, list[Edit]] = {}
            for edit in steps[at]:
                by_state.setdefault(edit[0], []).append(edit)
            fitting[at] = by_state
        if at < n:
            for _, to, more, letters in fitting[at].get(state, ()):
                if (at + 1, to) not in final:
                    heappush(agenda, (cost + more, audit + letters, at + 1, to))
        for _, to, more, letters in added.get(state, ()):
            if (at, to) not in final:
                heappush(agenda, (cost + more, audit + letters, at, to))
    return found
