"""Weighted repair of symbol sequences by generalised LR parsing.

A grammar becomes an SLR automaton. The parser's stacks are nodes of a graph that share what lies below them; equal
stacks are one node. A sequence is repaired row by row: a row is kept, given another symbol or deleted, and symbols
are inserted anywhere, each at its cost. Of all ways that lead to the same stack the one with the smallest
(cost, audit) stays.

What a row does to the stacks reached so far depends only on the differences of their costs and on the order of their
audits, so each such step is worked out once and looked up afterwards. A stack that another one can stand in for at
less cost, whatever follows, is dropped; so the differences are bounded and the steps are few.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Rule = tuple[str, tuple[str, ...]]

END = "$"
#: Ends the edits of a row in an edit string; symbols given or inserted follow their letter in lower case.
ROW = "|"
_TO_AUDIT = {ord(c): None for c in "abcdefghijklmnopqrstuvwxyz" + ROW}


def audit_of(edits: str) -> str:
    """The initials of the edits, K(eep), R(erole), D(elete) and I(nsert), in order."""
    return edits.translate(_TO_AUDIT)


class Automaton:
    """The SLR automaton of a grammar without hidden left recursion and the stacks it can reach, numbered from 0."""

    def __init__(self, rules: list[Rule], most_stacks: int = 10_000):
        start = "<start>"
        self.rules = [(start, (rules[0][0],)), *rules]
        self.names = {left for left, _ in self.rules}
        self.symbols = sorted({x for _, right in rules for x in right} - self.names)
        self.follow = self._follow(start)
        self.most_stacks = most_stacks
        self.states: dict[frozenset, int] = {}
        self._state({(0, 0)})
        self.items = list(self.states)
        #: A stack is the number of the stack below it and the state on top.
        self.stacks: list[tuple[int, int]] = [(-1, 0)]
        self.numbers = {(-1, 0): 0}
        self._moves: dict[tuple[int, str], frozenset[int]] = {}
        self._explore()

    def _follow(self, start: str) -> dict[str, set[str]]:
        first: dict[str, set[str]] = {x: {x} for x in self.symbols} | {x: set() for x in self.names}
        follow: dict[str, set[str]] = {x: set() for x in self.names}
        follow[start].add(END)
        empty: set[str] = set()
        size = -1
        while size != (size := len(empty) + sum(map(len, [*first.values(), *follow.values()]))):
            for left, right in self.rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for x in right:
                    first[left] |= first[x]
                    if x not in empty:
                        break
                after = set(follow[left])
                for x in reversed(right):
                    if x in self.names:
                        follow[x] |= after
                    after = after | first[x] if x in empty else set(first[x])
        return follow

    def _state(self, kernel: set[tuple[int, int]]) -> int:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            if dot < len(right):
                for i, (left, _) in enumerate(self.rules):
                    if left == right[dot] and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
        return self.states.setdefault(frozenset(items), len(self.states))

    def _goto(self, state: int, symbol: str) -> int | None:
        kernel = {(r, d + 1) for r, d in self.items[state] if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
        if not kernel:
            return None
        found = self._state(kernel)
        self.items = list(self.states)
        return found

    def _push(self, below: int, state: int) -> int:
        number = self.numbers.setdefault((below, state), len(self.stacks))
        if number == len(self.stacks):
            if number >= self.most_stacks:
                raise ValueError("the grammar nests without bound; write its repetitions left-recursively")
            self.stacks.append((below, state))
        return number

    def _reduced(self, stack: int, ahead: str | None) -> set[int]:
        """The stack and all it reduces to before ``ahead``; None: what must be reduced whatever comes."""
        found, todo = {stack}, [stack]
        while todo:
            at = todo.pop()
            items = self.items[self.stacks[at][1]]
            for rule, dot in items:
                left, right = self.rules[rule]
                if rule == 0 or dot < len(right) or (len(items) > 1 if ahead is None else ahead not in self.follow[left]):
                    continue
                below = at
                for _ in right:
                    below = self.stacks[below][0]
                to = self._push(below, self._goto(self.stacks[below][1], left))
                if ahead is None:
                    found.discard(at)
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return found

    def moves(self, stack: int, symbol: str) -> frozenset[int]:
        """The stacks after shifting ``symbol``."""
        if (stack, symbol) not in self._moves:
            out: set[int] = set()
            for at in self._reduced(stack, symbol):
                to = self._goto(self.stacks[at][1], symbol)
                if to is not None:
                    out |= self._reduced(self._push(at, to), None)
            self._moves[stack, symbol] = frozenset(out)
        return self._moves[stack, symbol]

    def accepts(self, stack: int) -> bool:
        return any((0, 1) in self.items[self.stacks[at][1]] for at in self._reduced(stack, END))

    def _explore(self) -> None:
        seen, todo = {0}, [0]
        while todo:
            at = todo.pop()
            for symbol in self.symbols:
                fresh = self.moves(at, symbol) - seen
                seen |= fresh
                todo += fresh
        self.reachable = sorted(seen)


@dataclass(frozen=True)
class Costs:
    delete: int = 4
    rerole: int = 3
    insert: int = 3
    #: Added for a truncated row that is not deleted.
    truncated: int = 3


@dataclass(frozen=True)
class Row:
    """What the repair has to know of a row: its symbol (or another text), and whether it must go or was cut off."""

    symbol: str
    must_go: bool = False
    truncated: bool = False


#: One reached stack: (stack, cost above the least, rank of its audit). Steps lead from one tuple of these to another.
Front = tuple[tuple[int, int, int], ...]


@dataclass
class Repairer:
    """Repairs sequences of rows; ``given`` are the symbols that rows may get and that may be inserted."""

    automaton: Automaton
    given: tuple[str, ...]
    costs: Costs = Costs()
    _steps: dict = field(default_factory=dict)

    def __post_init__(self):
        nodes = self.automaton.reachable
        self._inserts = {x: self._after_inserts(x) for x in nodes}
        self._ends = {x: [(len(i), i) for y, i in self._inserts[x].items() if self.automaton.accepts(y)] for x in nodes}
        self._stand_in = self._distances(nodes)

    def _after_inserts(self, stack: int) -> dict[int, str]:
        """Each stack that inserts alone lead to, with the fewest symbols, of equally few the first ones."""
        found, layer = {stack: ""}, [stack]
        while layer:
            ahead: dict[int, str] = {}
            for at in layer:
                for symbol in self.given:
                    for to in self.automaton.moves(at, symbol):
                        if to not in found:
                            ahead[to] = min(ahead.get(to, found[at] + symbol), found[at] + symbol)
            found |= ahead
            layer = list(ahead)
        return found

    def _distances(self, nodes: list[int]) -> dict[tuple[int, int], float]:
        """How much more the rest of any sequence may cost from stack y than from stack x.

        The least solution of: for each thing x may do with the next row or insert, y has an answer.
        """
        inf, c, auto = float("inf"), self.costs, self.automaton
        end = {x: min((n * c.insert for n, _ in self._ends[x]), default=inf) for x in nodes}
        after = {(x, s): auto.moves(x, s) for x in nodes for s in auto.symbols}
        far = {(y, x): 0.0 for y in nodes for x in nodes}

        def answer(y: int, x: int, symbol: str | None) -> float:
            """Least excess when x shifted the row's symbol and came to x; y deletes the row, keeps or changes it."""
            best = c.delete + far[y, x]
            for z, inserted in self._inserts[y].items():
                paid = len(inserted) * c.insert
                if symbol is not None:
                    best = min([best, *(paid + far[w, x] for w in after[z, symbol])])
                for s in self.given:
                    best = min([best, *(paid + c.rerole + far[w, x] for w in after[z, s])])
            return best

        for _ in range(10 * len(nodes)):
            new = {}
            for y, x in far:
                worst = end[y] - end[x] if end[x] < inf else 0.0
                for s in auto.symbols:
                    worst = max([worst, *(answer(y, w, s) for w in after[x, s])])
                for s in self.given:
                    for w in after[x, s]:
                        worst = max(worst, answer(y, w, None) - c.rerole, min(far[y, w], *(
                            len(i) * c.insert + far[z, w] for z, i in self._inserts[y].items())) - c.insert)
                new[y, x] = max(worst, 0.0) if y != x else 0.0
            if new == far:
                return far
            far = new
        return {pair: inf for pair in far}

    def start(self, stack: int = 0) -> Front:
        return ((stack, 0, 0),)

    def step(self, front: Front, row: Row, copies: int = 1) -> tuple[Front, int, list[tuple[int, str]]]:
        """The next front, what its least cost adds, and for each of its stacks where it came from and by what edits.

        Further copies of a row are duplicates and are deleted right after it: an insert between them could as well
        come later, with a smaller audit.
        """
        key = (front, row)
        if key not in self._steps:
            self._steps[key] = self._worked_out(front, row)
        new, added, back = self._steps[key]
        if copies > 1:
            return new, added + (copies - 1) * self.costs.delete, [(i, e + "D" * (copies - 1)) for i, e in back]
        return new, added, back

    def _worked_out(self, front: Front, row: Row) -> tuple[Front, int, list[tuple[int, str]]]:
        c, found = self.costs, {}

        def offer(stack: int, cost: int, i: int, edits: str) -> None:
            # No audit of a front begins another one: each has as many K, R and D, and ends with one of them.
            way = (cost, front[i][2], audit_of(edits), edits, i)
            if stack not in found or way < found[stack]:
                found[stack] = way

        for i, (stack, cost, _) in enumerate(front):
            offer(stack, cost + c.delete, i, "D")
            if row.must_go:
                continue
            extra = c.truncated if row.truncated else 0
            for at, inserted in self._inserts[stack].items():
                paid = cost + len(inserted) * c.insert + extra
                before = "".join("I" + s for s in inserted)
                if row.symbol in self.automaton.symbols:
                    for to in self.automaton.moves(at, row.symbol):
                        offer(to, paid, i, before + "K")
                for s in self.given:
                    for to in self.automaton.moves(at, s):
                        offer(to, paid + c.rerole, i, before + "R" + s)
        kept = {
            x: way
            for x, way in found.items()
            if not any(other[0] + self._stand_in[y, x] < way[0] for y, other in found.items() if y != x)
        }
        least = min(way[0] for way in kept.values())
        audits = sorted({way[1:3] for way in kept.values()})
        order = sorted(kept)
        new = tuple((x, kept[x][0] - least, audits.index(kept[x][1:3])) for x in order)
        return new, least, [(kept[x][4], kept[x][3]) for x in order]

    def ending(self, front: Front) -> tuple[int, int, str] | None:
        """Which stack of the front ends best: its place, what the last inserts cost, and these edits."""
        ways = [
            (cost + n * self.costs.insert, rank, "I" * n, i, "".join("I" + s for s in inserted))
            for i, (stack, cost, rank) in enumerate(front)
            for n, inserted in self._ends[stack]
        ]
        if not ways:
            return None
        best = min(ways)
        return best[3], best[0] - front[best[3]][1], best[4]

    def paths(self, rows: list[tuple[Row, int]], start: int = 0) -> list[tuple[int, int, list[str]]]:
        """For each stack reached from ``start``: the stack, the cost and the edits of each row."""
        front, total, trail = self.start(start), 0, []
        for row, copies in rows:
            front, added, back = self.step(front, row, copies)
            total += added
            trail.append(back)
        out = []
        for i, (stack, cost, _) in enumerate(front):
            edits, at = [], i
            for back in reversed(trail):
                at, own = back[at]
                edits.append(own)
            out.append((stack, total + cost, edits[::-1]))
        return out
