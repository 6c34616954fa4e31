"""Licence notices wherever they stand."""

from __future__ import annotations

import random

import pytest

from spanpack.llm import licenses

T = licenses.TEMPLATES


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("name", sorted(T))
def test_notice_in_a_long_line(name):
    rng = random.Random(name)
    scanner = licenses.Scanner(T)
    for n in (0, 700, 4000):
        before = words(rng, n)
        text = f"{before} {T[name]} {words(rng, n)}"
        found = [f for f in scanner.notices(text) if f[0] == name]
        assert [(f[1], f[4], f[5]) for f in found] == [(len(before) + 1, 1.0, "")]


def test_notice_in_a_long_run_of_telling_lines():
    lines = [f"the gnu general public license covers work {i} under section {i}" for i in range(600)]
    found = licenses.Scanner(T).notices("\n".join([*lines, T["GPL-3.0 header"], *lines]))
    assert [(f[0], f[4]) for f in found] == [("GPL-3.0 header", 1.0)]


def test_two_notices_side_by_side_and_overlapping():
    scanner = licenses.Scanner(T)
    text = " ".join([T["MIT"], T["MIT"], T["CC-BY-4.0"], T["MIT"]])
    assert [f[0] for f in scanner.notices(text)] == ["MIT", "MIT", "CC-BY-4.0", "MIT"]
    assert [f[0] for f in scanner.notices(T["Apache-2.0 header"])] == ["Apache-2.0 header"]
    assert scanner.notices("") == scanner.notices("license") == []
