"""Cutting a text where byte-level BPE always cuts it, so that results can be kept by chunk.

The tokenizers' own pattern never joins what a white-space boundary separates:
a run of white space gives up its last space to the word that follows, and
nothing else crosses.  A chunk is such a word with its space, or a run of white
space; the ids of a text are the ids of its chunks in order.
"""

from __future__ import annotations

import re

#: The characters with the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
find_chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+").findall

#: Signs that the pattern takes as a match of their own after a word.
SIGNS = frozenset(".,;:!?")
#: Chunks remembered in one Python worker, in each of two generations.
KEEP_CHUNKS = 300_000
#: Characters of text handled at a time.
BLOCK_CHARS = 2_000_000


def pieces(chunk: str, split) -> list[str]:
    """The chunk's matches of the tokenizer pattern; ``split`` finds them where it isn't plain.

    A word with its space, and at most one sign after it, needs no pattern:
    ``isalpha`` holds for exactly the letters of the pattern.
    """
    word = chunk[1:] if chunk[0] == " " else chunk
    if word.isalpha():
        return [chunk]
    if word[-1:] in SIGNS and word[:-1].isalpha():
        return [chunk[:-1], chunk[-1]]
    return split(chunk)


def blocks(rows, size):
    """Lists of consecutive rows of about BLOCK_CHARS together (at least one row each)."""
    block, held = [], 0
    for row in rows:
        block.append(row)
        held += size(row)
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


class Memory(dict):
    """Remembers what ``make`` made of a key, in two generations: a full one becomes the older, whose entries return when asked for."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turn(self) -> None:
        """Starts a new generation when this one is full."""
        if len(self) > self.size:
            self.older = dict(self)
            self.clear()
