"""A suffix automaton over word ids."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All substrings of several sequences. Sequences are joined by unique negative symbols, so
    no substring of words spans two of them. State 0 is the empty string; ``length`` is the
    longest string of a state and ``link`` the state of its longest proper suffix elsewhere."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.last = 0

    def add(self, sequence: Iterable[int]) -> list[int]:
        """Add one sequence; the state of each of its prefixes."""
        nxt, link, length = self.next, self.link, self.length
        states, last = [], self.last
        if last:
            last = self._extend(last, -len(length))
        for symbol in sequence:
            last = self._extend(last, symbol)
            states.append(last)
        self.last = last
        return states

    def _extend(self, last: int, symbol: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(length)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = clone
                    p = link[p]
                link[q] = link[new] = clone
        return new

    def holder(self, state: int, size: int) -> int:
        """The state of the suffix of ``size`` words of the strings of ``state``."""
        link, length = self.link, self.length
        while length[link[state]] >= size:
            state = link[state]
        return state

    def parents_first(self) -> list[int]:
        return sorted(range(1, len(self.length)), key=self.length.__getitem__)

    def matches(self, sequence: Sequence[int]) -> Iterable[tuple[int, int]]:
        """(state, length) of the longest suffix of each prefix that is a known substring."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for symbol in sequence:
            while symbol not in nxt[state]:
                state = link[state]
                if state < 0:
                    state = matched = 0
                    break
                matched = length[state]
            else:
                state = nxt[state][symbol]
                matched += 1
            yield state, matched
