"""A lexicon's trie intersected with Levenshtein automata of its terms, as one automaton over words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Signs that stand for letters in disguised words; an asterisk stands for any.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
ANY = "*"


def edits_allowed(term: str) -> int:
    """One edit from five letters on, two from nine on."""
    return (len(term) >= 5) + (len(term) >= 9)


class FuzzyTrie:
    """Finds, for each of many words, the lexicon's term that it is, begins with, or misspells.

    terms: whole words, and open ones, which match every word that begins with them. An edit
    is a letter too many, too few, another one, or two neighbours swapped. The
    automaton's states are sets of (place in the trie, edits so far); they and their steps
    are made when a word first asks for them, so that only what texts need is built."""

    def __init__(self, terms: Sequence[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]
        self.open: list[int] = [-1]
        self.most: list[int] = [0]  # edits that a term at or below the node allows
        self.edits = [0 if is_open else edits_allowed(t) for t, is_open in terms]
        self.longest = max((len(t) + e for (t, _), e in zip(terms, self.edits, strict=True)), default=0)
        for k, (term, is_open) in enumerate(terms):
            node = 0
            for c in term:
                self.most[node] = max(self.most[node], self.edits[k])
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    for column, empty in ((self.children, {}), (self.whole, -1), (self.open, -1), (self.most, 0)):
                        column.append(empty)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], self.edits[k])
            (self.open if is_open else self.whole)[node] = k
        letters = {c for t, _ in terms for c in t} | set(DISGUISE) | {ANY}
        self.letters = sorted(letters)
        self.codes = np.array([ord(c) for c in self.letters], np.uint32)
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict] = []
        self.steps = np.zeros((0, len(self.letters) + 1), np.int32)
        self._as_array = np.zeros((0, 3), np.int64)
        self.found: list[tuple[int, int, int]] = []  # of a state: whole term, its edits, open term
        self.dead = self._state({})
        self.start = self._state(self._closed({(0, ""): 0}))

    def _closed(self, at: dict) -> dict:
        """With the places that are reached by leaving out letters of a term."""
        todo = list(at.items())
        while todo:
            (node, owed), e = todo.pop()
            if owed or at.get((node, owed), 99) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and e + 1 < at.get((child, ""), 99):
                    at[child, ""] = e + 1
                    todo.append(((child, ""), e + 1))
        return at

    def _state(self, at: dict) -> int:
        key = frozenset(at.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(at)
            if len(self.sets) > len(self.steps):
                self.steps = np.vstack([self.steps, np.full((max(64, len(self.steps)), self.steps.shape[1]), -1, np.int32)])
            whole = min(((e, self.whole[n]) for (n, owed), e in at.items() if not owed and self.whole[n] >= 0 and e <= self.edits[self.whole[n]]), default=(0, -1))
            opened = max((self.open[n] for (n, owed), e in at.items() if not owed and not e), default=-1)
            self.found.append((whole[1], whole[0], opened))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        out: dict = {}

        def reach(node: int, owed: str, e: int) -> None:
            if e <= self.most[node] and e < out.get((node, owed), 99):
                out[node, owed] = e

        same = lambda c: c == letter or DISGUISE.get(letter) == c or letter == ANY
        for (node, owed), e in self.sets[state].items():
            if owed:
                if owed == letter:
                    reach(node, "", e)
                continue
            for c, child in self.children[node].items():
                reach(child, "", e if same(c) else e + 1)
                for d, grandchild in self.children[child].items():
                    if d == letter != c:
                        reach(grandchild, c, e + 1)
            reach(node, "", e + 1)
        return self._state(self._closed(out))

    def _known(self) -> np.ndarray:
        """`found`, as an array that is made again only when there are new states."""
        if len(self._as_array) != len(self.found):
            self._as_array = np.array(self.found)
        return self._as_array

    def match(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(term or -1, edits) of each word: the term that it is, else the longest that it begins with, else the one of the fewest edits."""
        term, edits = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        width = self.longest + 1
        if not len(words) or width == 1:
            return term, edits
        size = np.array([len(w) for w in words])
        letters = np.array([w[:width] for w in words], f"U{width}").view(np.uint32).reshape(len(words), width)
        kind = np.searchsorted(self.codes, letters)
        kind[(kind == len(self.codes)) | (self.codes[np.minimum(kind, len(self.codes) - 1)] != letters)] = len(self.codes)
        state, live, opened = np.full(len(words), self.start), np.arange(len(words)), np.full(len(words), -1, np.int64)
        for at in range(width):
            live = live[size[live] > at]
            asked = kind[live, at]
            now = self.steps[state[live], asked]
            while (now < 0).any():
                for s, k in {*zip(state[live][now < 0].tolist(), asked[now < 0].tolist(), strict=True)}:
                    to = self._step(s, self.letters[k] if k < len(self.letters) else "")
                    self.steps[s, k] = to
                now = self.steps[state[live], asked]
            state[live] = now
            found = self._known()
            opened[live] = np.where((found[now, 2] >= 0) & (size[live] > at + 1), found[now, 2], opened[live])
            live = live[now != self.dead]
        whole = self._known()[state]
        ends = (size <= width) & (whole[:, 0] >= 0) & (state != self.dead)
        exact = ends & (whole[:, 1] == 0)
        term = np.where(exact, whole[:, 0], np.where(opened >= 0, opened, np.where(ends, whole[:, 0], -1)))
        edits = np.where((term >= 0) & ~exact & (opened < 0), whole[:, 1], 0)
        return term, edits
