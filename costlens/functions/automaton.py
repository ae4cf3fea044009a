"""All occurrences of many words in one pass over a text."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

#: Letters that patterns take for an ASCII one when case is ignored, beside its other case; fixed values.
ALIKE = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}
ALNUM = re.compile("[A-Za-z0-9]", re.IGNORECASE)


def folded(text: str) -> str:
    """``text`` in lower case, character by character, so that places stay."""
    if text.isascii():
        return text.lower()
    return "".join(low if len(low := c.lower()) == 1 else c for c in text.translate(ALIKE))


class Automaton:
    """Words as paths from a root; where a path ends without the text's next letter, the longest end of what was read that
    begins a word goes on. Words are folded, and so is the text."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.back = [0]
        for i, word in enumerate(words):
            at = 0
            for c in folded(word):
                if c not in self.steps[at]:
                    self.steps[at][c] = len(self.steps)
                    self.steps.append({})
                    self.ends.append([])
                    self.back.append(0)
                at = self.steps[at][c]
            if word:
                self.ends[at].append(i)
        waiting = deque(self.steps[0].values())
        while waiting:
            at = waiting.popleft()
            for c, to in self.steps[at].items():
                near = self.back[at]
                while near and c not in self.steps[near]:
                    near = self.back[near]
                self.back[to] = self.steps[near].get(c, 0)
                self.ends[to] = self.ends[to] + self.ends[self.back[to]]
                waiting.append(to)

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(word's number, start, end) of every occurrence in a folded text, by end."""
        at = 0
        for place, c in enumerate(text, 1):
            while at and c not in self.steps[at]:
                at = self.back[at]
            at = self.steps[at].get(c, 0)
            for i in self.ends[at]:
                yield i, place - len(self.words[i]), place


def apart(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit stands next to a place of a text."""
    return not (start and ALNUM.match(text[start - 1])) and not (end < len(text) and ALNUM.match(text[end]))
