"""A suffix automaton over words that knows the first document of everything it contains."""

from __future__ import annotations

from collections.abc import Iterable


class SuffixAutomaton:
    """All runs of words of some passages; ``add`` them in the order of their documents' ids.

    A state stands for the runs that end at the same places, all suffixes of its longest one down to one word more
    than its link has. ``first`` is the document that made the state. Later documents can only add places, so that
    is the smallest id that has these runs; a clone has at least its original's places, and so inherits it.
    """

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.follow: list[dict[int, int]] = [{}]
        self.length, self.link, self.first = [0], [-1], [None]

    def _state(self, length: int, link: int, first, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.first.append(first)
        self.follow.append(follow)
        return len(self.length) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """The part of ``state`` that ``before`` leads to, as a state of its own."""
        clone = self._state(self.length[before] + 1, self.link[state], self.first[state], dict(self.follow[state]))
        self.link[state] = clone
        while before >= 0 and self.follow[before].get(word) == state:
            self.follow[before][word] = clone
            before = self.link[before]
        return clone

    def add(self, words: Iterable[bytes], doc: int) -> None:
        numbers, follow, length, link = self.numbers, self.follow, self.length, self.link
        last = 0
        for text in words:
            word = numbers.setdefault(text, len(numbers))
            known = follow[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, word, known)
                continue
            new = self._state(length[last] + 1, 0, doc, {})
            while last >= 0 and word not in follow[last]:
                follow[last][word] = new
                last = link[last]
            if last >= 0:
                state = follow[last][word]
                link[new] = state if length[state] == length[last] + 1 else self._split(last, word, state)
            last = new

    def repeats(self, words: list[bytes], doc: int, least: int) -> list[int]:
        """Starts of the runs of ``least`` words that a document before ``doc`` has.

        The matching statistic - how long a suffix of what was read is in the automaton - is held at ``least``: the
        state is always the one whose runs include the last ``least`` words, if those are in the automaton at all.
        """
        numbers, follow, length, link, first = self.numbers, self.follow, self.length, self.link, self.first
        state = size = 0
        starts = []
        for at, text in enumerate(words):
            word = numbers.get(text)
            if word is None:
                state = size = 0
                continue
            while state and word not in follow[state]:
                state = link[state]
                size = length[state]
            state = follow[state].get(word, 0)
            size = size + 1 if state else 0
            if size >= least:
                while length[link[state]] >= least:
                    state = link[state]
                size = least
                if first[state] < doc:
                    starts.append(at - least + 1)
        return starts
