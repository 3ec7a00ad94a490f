"""Cutting a text into chunks that byte-level BPE encodes independently.

A byte-level pre-token never holds a blank except as its first character, so a single
blank between two non-blank characters always starts a new pre-token and nothing before
it matters: texts fall apart there into chunks that repeat very often.
"""

from __future__ import annotations

import re

SPECIAL = "<|endoftext|>"
_NEIGHBOURS = re.compile(r" \s|\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Entries a worker remembers, and the longest chunk worth an entry (memory: some 60 MB).
MEMORY, LONGEST = 250_000, 48


def chunks(text: str) -> list[str]:
    """The chunks of a text; all but the first have lost the one blank they start with."""
    return _CUT.split(text) if _NEIGHBOURS.search(text) else text.split(" ")
