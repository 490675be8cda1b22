"""A chat template with turn markers and reversible escapes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

# The control strings of the template.
TURN_START, TURN_END, ROLE_BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(TURN_START) + r"(.*?)\n(.*?)" + re.escape(TURN_END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    """Put one more backslash between every ``<`` and ``|`` that only backslashes part; no control string survives."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def turn(role: str, text: str) -> str:
    """Text of one turn."""
    return f"{TURN_START}{escape(role).replace(chr(10), ROLE_BREAK)}\n{escape(text)}{TURN_END}\n"


class TurnByTurn:
    """A template that is the join of its turns by construction, so conversations may be rendered in pieces."""

    def __init__(self, turn: Callable[[str, str], str]):
        self.turn = turn

    def __call__(self, messages: Sequence[tuple[str, str]]) -> str:
        return "".join(self.turn(role, text) for role, text in messages)


render = TurnByTurn(turn)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) list back from ``render``'s output; raises where the output is not of that form."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1].replace(ROLE_BREAK, "\n")), unescape(found[2])))
        at = found.end()
    return turns
