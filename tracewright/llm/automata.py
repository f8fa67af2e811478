"""Probabilistic automata inferred from labelled strings by merging compatible states of a prefix tree."""

from __future__ import annotations

import math
from collections import defaultdict

END = ""


def symbol(c: str) -> str:
    """Letters by case, a-f and A-F apart as they are hexadecimal digits too, digits, and every other character itself."""
    if c.isdigit():
        return "0"
    if c.islower():
        return "a" if c <= "f" else "z"
    if c.isupper():
        return "A" if c <= "F" else "Z"
    return c


class Automaton:
    """States count how often they are passed, left by a symbol, and ended in."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]
        self.total: list[int] = [0]

    def _add(self, state: int, s: str, n: int = 1) -> None:
        self.count[state][s] += n
        self.total[state] += n

    def learn(self, symbols: list[str]) -> None:
        state = 0
        for s in symbols:
            self._add(state, s)
            if s not in self.next[state]:
                self.next[state][s] = len(self.next)
                self.next.append({})
                self.count.append(defaultdict(int))
                self.total.append(0)
            state = self.next[state][s]
        self._add(state, END)

    def _differ(self, a: int, b: int, s: str, alpha: float) -> bool:
        """Hoeffding's bound on the difference of two observed shares."""
        n, m = self.total[a], self.total[b]
        if not n or not m:
            return False
        gap = abs(self.count[a][s] / n - self.count[b][s] / m)
        return gap > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int, alpha: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if any(self._differ(a, b, s, alpha) for s in {*self.count[a], *self.count[b]}):
                return False
            todo += [(self.next[a][s], self.next[b][s]) for s in self.next[a].keys() & self.next[b].keys() if self.next[a][s] != self.next[b][s]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds b's subtree, a tree yet, to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for s, n in self.count[b].items():
                self._add(a, s, n)
            for s, child in self.next[b].items():
                if s in self.next[a]:
                    todo.append((self.next[a][s], child))
                else:
                    self.next[a][s] = child

    def merge(self, alpha: float) -> None:
        """Red states are settled; each blue child of a red one is folded into the first compatible red state, or becomes red."""
        red, seen = [0], {0}
        while True:
            blue = sorted((c, r, s) for r in red for s, c in self.next[r].items() if c not in seen)
            if not blue:
                break
            child, parent, s = blue[0]
            for r in red:
                if self._compatible(r, child, alpha):
                    self.next[parent][s] = r
                    self._fold(r, child)
                    break
            else:
                red.append(child)
                seen.add(child)
        number = {r: k for k, r in enumerate(red)}
        self.next = [{s: number[c] for s, c in self.next[r].items()} for r in red]
        self.count, self.total = [dict(self.count[r]) for r in red], [self.total[r] for r in red]

    def score(self, symbols: list[str], alphabet: int) -> float:
        """Mean log-likelihood of a symbol and the end, with one unseen count spread over the alphabet; an unseen step stays in its state."""
        state, total = 0, 0.0
        for s in [*symbols, END]:
            total += math.log((self.count[state].get(s, 0) + 1 / alphabet) / (self.total[state] + 1))
            state = self.next[state].get(s, state)
        return total / (len(symbols) + 1)


def infer(strings: list[str], alpha: float = 0.05) -> Automaton:
    out = Automaton()
    for x in sorted(strings):
        out.learn([symbol(c) for c in x])
    out.merge(alpha)
    return out
