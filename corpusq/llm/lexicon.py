"""A trie of terms and its intersection with Levenshtein automata.

A term is either a whole word or a stem that any ending may follow. The automaton of a word
accepts what lies within one edit; walking it and the trie together visits only branches
that both still allow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Terms shorter than this match exactly only.
FUZZY_LENGTH = 5


@dataclass
class Node:
    children: dict[str, "Node"] = field(default_factory=dict)
    word: int | None = None
    stem: int | None = None


class Lexicon:
    """``terms``: (text, is_stem) pairs, numbered in order."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.root = Node()
        for number, (text, is_stem) in enumerate(terms):
            node = self.root
            for char in text:
                node = node.children.setdefault(char, Node())
            if is_stem:
                node.stem = number
            else:
                node.word = number
        self.sieve = self._sieve()

    def _sieve(self) -> str:
        """A regex that every word within one edit of a term matches: one edit leaves one
        half of the term as it is, in place or moved by one."""
        starts, inner = set(), {}
        for text, _ in self.terms:
            half = len(text) // 2
            starts.add(text[:half] if len(text) >= FUZZY_LENGTH else text)
            if len(text) >= FUZZY_LENGTH:
                inner.setdefault(half, set()).add(text[half:])
        options = ["^(?:" + "|".join(map(re.escape, sorted(starts))) + ")"] if starts else []
        for half, ends in sorted(inner.items()):
            options.append(f"^.{{{half - 1},{half + 1}}}(?:" + "|".join(map(re.escape, sorted(ends))) + ")")
        return "|".join(options) or "^$a"

    def match(self, word: str) -> tuple[int, int] | None:
        """(number, edits) of the best term for ``word``: fewest edits, then longest term."""
        best = None

        def take(number: int | None, edits: int) -> None:
            nonlocal best
            if number is None or (edits and len(self.terms[number][0]) < FUZZY_LENGTH):
                return
            rank = (edits, -len(self.terms[number][0]), number)
            if best is None or rank < best:
                best = rank

        # A state of the automaton is (place in the word, edits made); a frontier holds the
        # states reached along with a trie node.
        def close(states: dict[int, int]) -> dict[int, int]:
            for place in sorted(states):  # a word's extra letter costs an edit
                edits = states[place] + 1
                if edits <= 1 and place < len(word) and states.get(place + 1, 9) > edits:
                    states[place + 1] = edits
            return states

        stack = [(self.root, close({0: 0}))]
        while stack:
            node, states = stack.pop()
            if node.stem is not None:
                take(node.stem, min(states.values()))
            if node.word is not None and len(word) in states:
                take(node.word, states[len(word)])
            for char, child in node.children.items():
                reached: dict[int, int] = {}
                for place, edits in states.items():
                    if place < len(word):
                        same = word[place] == char
                        if edits + (not same) <= 1:
                            reached[place + 1] = min(reached.get(place + 1, 9), edits + (not same))
                    if edits == 0:  # the term's letter is missing in the word
                        reached[place] = min(reached.get(place, 9), 1)
                if reached:
                    stack.append((child, close(reached)))
        return None if best is None else (best[2], best[0])
