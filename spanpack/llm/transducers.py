"""Weighted finite-state transducers over small alphabets, and their composition.

A transducer reads a symbol, writes symbols (none, one or several) and moves on.
:func:`compose` feeds what the first writes to the second; the result is again
one table of transitions over pairs of states, of which only those that can be
reached are made. :class:`Machine` numbers such a table for running it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass

State, Symbol = Hashable, str


@dataclass(frozen=True)
class Transducer:
    """``starts``: named start states. ``step(state, symbol)`` gives the next
    state and the symbols written; symbols it does not know pass through."""

    starts: dict[str, State]
    step: Callable[[State, Symbol], tuple[State, tuple[Symbol, ...]]]


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` writes, ``second`` reads. Start states are paired by name."""

    def step(state, symbol):
        a, b = state
        a, written = first.step(a, symbol)
        out: list[Symbol] = []
        for w in written:
            b, more = second.step(b, w)
            out += more
        return (a, b), tuple(out)

    return Transducer({name: (first.starts[name], second.starts[name]) for name in first.starts}, step)


def compose_all(cascade: Iterable[Transducer]) -> Transducer:
    it = iter(cascade)
    whole = next(it)
    for t in it:
        whole = compose(whole, t)
    return whole


class Machine:
    """A transducer as a table: for each numbered state and input symbol the
    next state and what is written."""

    def __init__(self, t: Transducer, alphabet: Iterable[Symbol]) -> None:
        number: dict[State, int] = {}
        todo: deque[State] = deque()

        def of(state: State) -> int:
            if state not in number:
                number[state] = len(number)
                todo.append(state)
            return number[state]

        self.starts = {name: of(s) for name, s in t.starts.items()}
        self.table: list[dict[Symbol, tuple[int, tuple[Symbol, ...]]]] = []
        alphabet = list(alphabet)
        while todo:
            state = todo.popleft()
            row = {}
            for symbol in alphabet:
                after, written = t.step(state, symbol)
                row[symbol] = (of(after), written)
            self.table.append(row)

    def run(self, symbols: Iterable[Symbol], start: str) -> Iterable[tuple[Symbol, ...]]:
        """What is written at each symbol."""
        state = self.starts[start]
        for s in symbols:
            state, written = self.table[state][s]
            yield written
