"""Merging sorted runs with a tree of losers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class _End:
    """Greater than every key."""

    def __lt__(self, other) -> bool:
        return False


END = _End()


def _less(a, b) -> bool:
    if a is END:
        return False
    return b is END or a < b


def merge(runs: Sequence[Iterable]) -> Iterator:
    """All items of the sorted runs, each a (key, anything), in order of their keys; equal keys by run.

    A run is read item by item: one of each is held. Every inner node of the tree keeps the run that lost the comparison
    there, and the top the overall winner. When the winner's run moves on, only the comparisons on its way up
    are made again: one for each level, log2(k) an item.
    """
    k = len(runs)
    if not k:
        return
    runs = [iter(run) for run in runs]
    items = [next(run, END) for run in runs]

    def head(run: int):
        return items[run] if items[run] is END else (items[run][0], run)

    heads = [head(i) for i in range(k)]
    losers = [0] * k
    # Play the first round from the leaves up: leaf i is node k + i.
    winner = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        won, lost = (b, a) if _less(heads[b], heads[a]) else (a, b)
        winner[node], losers[node] = won, lost
    top = winner[1] if k > 1 else 0
    while heads[top] is not END:
        yield items[top]
        items[top] = next(runs[top], END)
        heads[top] = head(top)
        node = (k + top) // 2
        while node >= 1 and k > 1:
            if _less(heads[losers[node]], heads[top]):
                losers[node], top = top, losers[node]
            node //= 2
