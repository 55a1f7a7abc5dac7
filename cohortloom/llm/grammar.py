"""Least-cost repair of role sequences by a generalised LR parser.

The automaton is built from the productions. The parser reads one symbol per row; its
graph-structured stack is a frontier of stack tops, each with the stack below it. A row may be
kept, reroled, deleted, or have symbols inserted before it, each at a cost. Stacks with equal
tops are merged by the minimum of (cost, audit), where the audit is the text of the edits' initials.

Audits are never compared as texts. All tops of a frontier have read the same rows, and every
audit ends with the letter of a row, so none is the beginning of another: the order of two longer
audits is that of their beginnings, and of their last letters where these are the same. A frontier
is therefore a tuple of (stack, cost above the least) in the order of the audits, of which there
are few; each step is computed once and looked up after that.
"""

from __future__ import annotations

from collections.abc import Sequence

Production = tuple[str, tuple[str, ...]]
Frontier = tuple[tuple[int, int], ...]
Edit = tuple[str, str]

# (s?(ua)+)? with the start symbol first.
ROLES: tuple[Production, ...] = (
    ("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")),
)
# More stacks than this mean that the grammar nests, and rows could not be read in pieces.
MOST_STACKS = 256


class Automaton:
    """LR(0) states of a grammar, and the finitely many stacks that reading symbols leads to."""

    def __init__(self, productions: Sequence[Production]):
        self.productions, self.start = tuple(productions), productions[0][0]
        self.heads = {head for head, _ in productions}
        self.symbols = {x for _, body in productions for x in body} - self.heads
        self._items: list[frozenset] = []
        self._goto: dict[tuple[int, str], int] = {}
        self._state(frozenset((p, 0) for p, (head, _) in enumerate(self.productions) if head == self.start))
        self.stacks: list[tuple[int, ...]] = [(0,)]
        for stack in self.stacks:
            for x in sorted(self.symbols):
                for after in self._read(stack, x):
                    if after not in self.stacks:
                        self.stacks.append(after)
            if len(self.stacks) > MOST_STACKS:
                raise ValueError("the grammar has too many stacks")
        place = {stack: i for i, stack in enumerate(self.stacks)}
        self.top = [stack[-1] for stack in self.stacks]
        self.after = {
            (i, x): [place[s] for s in self._read(stack, x)] for i, stack in enumerate(self.stacks) for x in self.symbols
        }
        self.accepts = [any(s == () for s in self._reduced(stack, True)) for stack in self.stacks]

    def _state(self, kernel: frozenset) -> int:
        items, waiting = set(kernel), list(kernel)
        while waiting:
            p, dot = waiting.pop()
            body = self.productions[p][1]
            for q, (head, _) in enumerate(self.productions):
                if dot < len(body) and head == body[dot] and (q, 0) not in items:
                    items.add((q, 0))
                    waiting.append((q, 0))
        whole = frozenset(items)
        if whole in self._items:
            return self._items.index(whole)
        self._items.append(whole)
        number = len(self._items) - 1
        nexts = {self.productions[p][1][dot] for p, dot in whole if dot < len(self.productions[p][1])}
        for x in sorted(nexts):
            moved = frozenset(
                (p, dot + 1) for p, dot in whole if dot < len(self.productions[p][1]) and self.productions[p][1][dot] == x
            )
            self._goto[number, x] = self._state(moved)
        return number

    def _complete(self, state: int) -> list[int]:
        return [p for p, dot in self._items[state] if dot == len(self.productions[p][1])]

    def _reduced(self, stack: tuple[int, ...], at_end: bool) -> list[tuple[int, ...]]:
        """The stack and all that reductions make of it; an accepted one is empty.

        The start symbol is only reduced at the end.
        """
        found = [stack]
        for known in found:
            for p in self._complete(known[-1]) if known else ():
                head, body = self.productions[p]
                below = known[: len(known) - len(body)]
                if head == self.start:
                    after = () if at_end and below == (0,) else None
                else:
                    after = (*below, self._goto[below[-1], head]) if (below[-1], head) in self._goto else None
                if after is not None and after not in found:
                    found.append(after)
        return found

    def _read(self, stack: tuple[int, ...], x: str) -> list[tuple[int, ...]]:
        """Stacks after a symbol; one that can only be reduced further is left out."""
        state = self._goto.get((stack[-1], x))
        if state is None:
            return []
        return [s for s in self._reduced((*stack, state), False) if self._reads_on(s[-1])]

    def _reads_on(self, state: int) -> bool:
        ends = any(self.productions[p][0] == self.start for p in self._complete(state))
        return ends or any((state, x) in self._goto for x in self.symbols)


class Parser:
    """Weighted repair; ``insertable`` symbols may be inserted and given to rows."""

    def __init__(
        self,
        productions: Sequence[Production] = ROLES,
        insertable: Sequence[str] = ("u", "a"),
        insert: int = 2,
        rerole: int = 2,
        delete: int = 3,
        truncated: int = 1,
    ):
        self.automaton = Automaton(productions)
        self.insertable = tuple(insertable)
        self.costs = {"I": insert, "R": rerole, "D": delete, "K": 0}
        self.truncated = truncated
        self._steps: dict[tuple[Frontier, str], tuple[Frontier, int, tuple]] = {}

    @property
    def stacks(self) -> int:
        return len(self.automaton.stacks)

    def _merge(self, candidates) -> list:
        """The least of (cost, place of the audit so far, letters added) of each top."""
        best: dict[int, tuple] = {}
        for c in candidates:
            top = self.automaton.top[c[3]]
            if top not in best or c < best[top]:
                best[top] = c
        return list(best.values())

    def _with_inserts(self, frontier: Frontier) -> list:
        """(cost, place, letters, stack, edits) of the frontier and of all it becomes by inserts."""
        found = self._merge((cost, place, "", stack, ()) for place, (stack, cost) in enumerate(frontier))
        while True:
            more = [
                (cost + self.costs["I"], place, letters + "I", after, (*edits, ("I", x)))
                for cost, place, letters, stack, edits in found
                for x in self.insertable
                for after in self.automaton.after.get((stack, x), ())
            ]
            merged = self._merge(found + more)
            if sorted(merged) == sorted(found):
                return found
            found = merged

    def step(self, frontier: Frontier, symbol: str) -> tuple[Frontier, int, tuple]:
        """Frontier after a row, the least cost added, and (place before, edits) of each of its tops.

        A symbol is the row's initial and a mark: ``!`` must be deleted, ``~`` is truncated.
        """
        known = self._steps.get((frontier, symbol))
        if known:
            return known
        initial, mark = symbol[0], symbol[1:]
        made = []
        for cost, place, letters, stack, edits in self._with_inserts(frontier):
            made.append((cost + self.costs["D"], place, letters + "D", stack, (*edits, ("D", ""))))
            if mark == "!":
                continue
            cost += self.truncated if mark == "~" else 0
            for after in self.automaton.after.get((stack, initial), ()):
                made.append((cost, place, letters + "K", after, (*edits, ("K", ""))))
            for x in self.insertable:
                for after in self.automaton.after.get((stack, x), ()):
                    made.append((cost + self.costs["R"], place, letters + "R", after, (*edits, ("R", x))))
        kept = sorted(self._merge(made), key=lambda c: (c[1], c[2]))
        least = min(c[0] for c in kept)
        result = (
            tuple((c[3], c[0] - least) for c in kept), least, tuple((c[1], c[4]) for c in kept)
        )
        self._steps[frontier, symbol] = result
        return result

    def run(self, symbols: Sequence[str], stack: int = 0) -> tuple[Frontier, int, list[tuple]]:
        """Frontier after all rows read from one stack, its least cost, and the steps back."""
        frontier: Frontier = ((stack, 0),)
        total, back = 0, []
        for symbol in symbols:
            frontier, cost, links = self.step(frontier, symbol)
            total += cost
            back.append(links)
        return frontier, total, back

    def accept(self, frontier: Frontier) -> tuple[int, int, tuple[Edit, ...]]:
        """(cost above the least, place, last inserts) of the best accepted top."""
        ends = [c for c in self._with_inserts(frontier) if self.automaton.accepts[c[3]]]
        cost, place, _, _, edits = min(ends, key=lambda c: c[:3])
        return cost, place, edits

    def edits(self, back: list[tuple], place: int) -> list[tuple[Edit, ...]]:
        """The edits of each row on the way to a top."""
        out = []
        for links in reversed(back):
            place, edits = links[place]
            out.append(edits)
        return out[::-1]

    def summary(self, symbols: Sequence[str]) -> list[list[tuple[int, int]]]:
        """From each stack the tops that the rows lead to, as (stack, cost) in the order of their audits."""
        out = []
        for stack in range(self.stacks):
            frontier, total, _ = self.run(symbols, stack)
            out.append([(s, total + c) for s, c in frontier])
        return out

    def join(self, frontier: Frontier, summary) -> tuple[Frontier, int, list[tuple[int, int]]]:
        """Frontier after a piece of rows by its summary, the cost added, and where each top came from.

        The latter as (place before, stack at the end of the piece).
        """
        made = [
            (cost + more, place, nth, stack)
            for place, (before, cost) in enumerate(frontier)
            for nth, (stack, more) in enumerate(summary[before])
        ]
        kept = sorted(self._merge(made), key=lambda c: c[1:3])
        least = min(c[0] for c in kept)
        return tuple((c[3], c[0] - least) for c in kept), least, [(c[1], c[3]) for c in kept]
