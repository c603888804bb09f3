"""Texts that every match of a regular expression must contain.

Sent to the executors with the job, so it uses nothing of this package.
"""

import re
from re import _constants as kinds
from re import _parser as parser

# A literal of so many letters is worth an index entry.
SHORTEST = 3

# Java writes these differently than Python's parser reads them: inline flags and names,
# classes inside classes, and intersections.
_UNREADABLE = re.compile(r"\(\?(?![:=!]|<[=!])|\[[^\]]*\[|&&")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def required(pattern: str) -> list[str] | None:
    """Literals, in lower-case ASCII letters, of which every match contains one.

    One for each alternative of the pattern, each of `SHORTEST` letters at least; None if
    there is an alternative without such a literal, or the pattern cannot be read.
    """
    if _UNREADABLE.search(pattern):
        return None
    try:
        tree = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    found = _of_sequence(tree)
    return None if found is None else sorted(set(found))


def _of_sequence(tree) -> list[str] | None:
    """The best choice among the parts that all have to match one after another."""
    choices, run = [], ""
    for kind, value in tree:
        if kind is kinds.LITERAL:
            run += chr(_LOWER.get(value, value))
            continue
        if kind is kinds.AT:  # an anchor or a word boundary takes no letters
            continue
        choices.append([run])
        run = ""
        if kind is kinds.SUBPATTERN:
            choices.append(_of_sequence(value[-1]))
        elif kind is kinds.BRANCH:
            branches = [_of_sequence(branch) for branch in value[1]]
            if all(b is not None for b in branches):
                choices.append([literal for b in branches for literal in b])
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0]:
            choices.append(_of_sequence(value[-1]))
    choices.append([run])
    usable = [c for c in choices if c and min(map(len, c)) >= SHORTEST]
    return max(usable, key=lambda c: (min(map(len, c)), -len(c)), default=None)
