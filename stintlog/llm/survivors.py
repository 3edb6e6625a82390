"""Viterbi over the states of a repaired conversation, with survivors that coalesce.

Each state keeps one survivor: a path of edits in a tree of back pointers. A path that no survivor
needs any more goes, by counts of references. Once all survivors share an ancestor, the edits up to
it are final and are handed out, so what is held is what is still undecided, not the conversation.
Paths of equal cost are compared by all their undecided edits: the first letters behind the place
where they part decide.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

# Where a repaired conversation may stand: before anything, after a system turn, a user's, an
# assistant's. It may end at START or ASSISTANT.
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1  # costs
NEVER = 1 << 60
SETTLE = 64  # rows between two looks for a shared ancestor

# State and initial of a kept role to the next state; any other pair cannot be kept.
_KEEPS = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
# The next state of a turn whose role is chosen, and the role.
_CHOSEN = [(USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user")]


class Survivors:
    """The cheapest edits of one conversation, fed row by row.

    ``emit(letter, row, role)`` gets every final edit in order: K, R, D with the row, I with None;
    ``role`` is the chosen one of R and I.
    """

    def __init__(self, emit: Callable[[str, object, str | None], None]):
        self._emit = emit
        self._parent, self._letter, self._refs, self._depth = [0], [""], [1], [0]
        self._jump, self._jump_depth = [0], [0]
        self._free: list[int] = []
        self._base = 0  # the last node handed out; held by one reference
        self._place = START  # of the repaired conversation, as far as handed out
        self._rows: deque = deque()  # that wait for their edit
        self._since = 0
        self._node = [self._hold(0), None, None, None]
        self._cost = [0, NEVER, NEVER, NEVER]
        self._insert()

    # The tree.

    def _hold(self, node: int) -> int:
        self._refs[node] += 1
        return node

    def _child(self, parent: int, letter: str) -> int:
        """A new node, held once by the caller."""
        depth = self._depth[parent] + 1
        jump, jump_depth = parent, depth - 1
        # Jumps in steps of growing size, as long as they stay below what was handed out.
        if self._jump_depth[parent] >= self._depth[self._base]:
            over = self._jump[parent]
            if self._depth[parent] - self._depth[over] == self._depth[over] - self._jump_depth[over]:
                if self._jump_depth[over] >= self._depth[self._base]:
                    jump, jump_depth = self._jump[over], self._jump_depth[over]
        values = (parent, letter, 1, depth, jump, jump_depth)
        lists = (self._parent, self._letter, self._refs, self._depth, self._jump, self._jump_depth)
        if self._free:
            node = self._free.pop()
            for held, value in zip(lists, values):
                held[node] = value
        else:
            node = len(self._parent)
            for held, value in zip(lists, values):
                held.append(value)
        self._refs[parent] += 1
        return node

    def _release(self, node: int) -> None:
        refs, parent = self._refs, self._parent
        refs[node] -= 1
        while not refs[node]:  # the base is always held
            self._free.append(node)
            node = parent[node]
            refs[node] -= 1

    def _fork(self, a: int, b: int) -> tuple[int, int | None, int | None]:
        """The last shared ancestor, and the next node towards either; None where that is it itself."""
        parent, depth, jump, jump_depth = self._parent, self._depth, self._jump, self._jump_depth
        floor = depth[self._base]
        next_a = next_b = None
        while depth[a] > depth[b]:
            if jump_depth[a] > depth[b] and jump_depth[a] >= floor:
                a = jump[a]
            else:
                next_a, a = a, parent[a]
        while depth[b] > depth[a]:
            if jump_depth[b] > depth[a] and jump_depth[b] >= floor:
                b = jump[b]
            else:
                next_b, b = b, parent[b]
        while a != b:
            if floor <= jump_depth[a] == jump_depth[b] and jump[a] != jump[b]:
                a, b = jump[a], jump[b]
            else:
                next_a, a = a, parent[a]
                next_b, b = b, parent[b]
        return a, next_a, next_b

    def _less(self, a: int, letter_a: str, b: int, letter_b: str) -> bool:
        """Whether the edits of ``a`` and its letter are before those of ``b`` and its letter."""
        if a == b:
            return letter_a < letter_b
        _, next_a, next_b = self._fork(a, b)
        first_a = letter_a if next_a is None else self._letter[next_a]
        first_b = letter_b if next_b is None else self._letter[next_b]
        return first_a < first_b

    # The rows.

    def _best(self, choices: list[tuple[int, int, str]]) -> tuple[int, int, str] | None:
        """Of (cost, node, letter) the cheapest; ties to the least edits."""
        best = None
        for choice in choices:
            if choice[0] >= NEVER:
                continue
            if best is None or choice[0] < best[0] or choice[0] == best[0] and self._less(choice[1], choice[2], best[1], best[2]):
                best = choice
        return best

    def _insert(self) -> None:
        """Let each state also be reached by inserted turns."""
        cost, node = self._cost, self._node
        for state, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            own = (cost[state], node[state], "")
            best = self._best([own, *((cost[s] + INSERT, node[s], "I") for s in sources)])
            if best is None or best is own:
                continue
            made = self._child(best[1], "I")
            if node[state] is not None:
                self._release(node[state])
            cost[state], node[state] = best[0], made
        # Whatever follows START or SYSTEM may follow ASSISTANT too, but that a system turn kept after
        # START is deleted there. One that costs more all the same can never win, nor tie.
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            if node[state] is not None and cost[state] > cost[ASSISTANT] + more:
                self._release(node[state])
                cost[state], node[state] = NEVER, None

    def add(self, row: object, role: str, must_go: bool, unfinished: bool) -> None:
        """The next row. One that must go is never handed out other than as deleted: give None for it."""
        self._rows.append(row)
        cost, node = self._cost, self._node
        choices: list[list[tuple[int, int, str]]] = [[], [], [], []]
        late = UNFINISHED if unfinished else 0
        for state in range(4):
            if cost[state] >= NEVER:
                continue
            choices[state].append((cost[state] + DELETE, node[state], "D"))
            if must_go:
                continue
            kept = _KEEPS.get((state, role[:1]))
            if kept is not None:
                choices[kept].append((cost[state] + late, node[state], "K"))
            else:
                choices[_CHOSEN[state][0]].append((cost[state] + REROLE + late, node[state], "R"))
        found = [self._best(c) for c in choices]
        made = [None if f is None else self._child(f[1], f[2]) for f in found]
        for n in node:
            if n is not None:
                self._release(n)
        self._node = made
        self._cost = [NEVER if f is None else f[0] for f in found]
        self._insert()
        self._since += 1
        if self._since >= SETTLE:
            self._settle([n for n in self._node if n is not None])

    def _settle(self, nodes: list[int]) -> None:
        """Hand out all edits that the given survivors share."""
        self._since = 0
        shared = nodes[0]
        for other in nodes[1:]:
            shared = self._fork(shared, other)[0]
        if shared == self._base:
            return
        path, at = [], shared
        while at != self._base:
            path.append(self._letter[at])
            at = self._parent[at]
            self._free.append(at)
        self._base = self._hold(shared)
        for letter in reversed(path):
            row = None if letter == "I" else self._rows.popleft()
            role = None
            if letter in "IR":
                self._place, role = _CHOSEN[self._place]
            elif letter == "K":
                self._place = _KEEPS[self._place, row[0][:1]]
            self._emit(letter, row, role)

    def finish(self) -> int:
        """Hand out the rest; the cost of all edits."""
        end = START
        if self._cost[ASSISTANT] < self._cost[START]:
            end = ASSISTANT
        elif self._cost[ASSISTANT] == self._cost[START] and self._less(self._node[ASSISTANT], "", self._node[START], ""):
            end = ASSISTANT
        self._settle([self._node[end]])
        return self._cost[end]

    @property
    def held(self) -> int:
        """Nodes in the tree."""
        return len(self._parent) - len(self._free)
