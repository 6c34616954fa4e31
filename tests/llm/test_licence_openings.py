"""Licence notices with other openings, losses and insertions."""

from __future__ import annotations

import random

from spanpack.llm import licenses

T = licenses.TEMPLATES


def test_notice_with_another_opening():
    header = T["GPL-3.0 header"].replace("This program", "FooBar")
    got = licenses.Scanner(T).notices("x y " + header)
    assert [(f[0], f[1], f[5]) for f in got] == [("GPL-3.0 header", len("x y FooBar "), "-this -program")]


def test_no_candidate_is_left_out():
    """Every template's notice, though the parts of four others save more."""
    scanner = licenses.Scanner(T)
    parts = " ".join(" ".join(T[n].split()[: 2 * len(T[n].split()) // 3]) for n in ("GPL-3.0 header", "MIT permission", "Apache-2.0 header", "BSD-3-Clause", "CC0-1.0"))
    for name in ("CC-BY-4.0", "MIT", "Apache-2.0", "MPL-2.0"):
        assert name in {f[0] for f in scanner.notices(f"{parts} {T[name]}")}


def test_words_that_satisfy_cover_are_found():
    """Random losses and insertions up to what COVER allows."""
    rng = random.Random(4)
    scanner = licenses.Scanner(T)
    for k, name in enumerate(scanner.names):
        template = scanner.words[k]
        for _ in range(40):
            free = [x for x in range(len(template)) if x not in scanner.required[k]]
            gone = set(rng.sample(free, rng.randint(0, len(template) - scanner.least[k])))
            kept = [w for x, w in enumerate(template) if x not in gone]
            for _ in range(rng.randint(0, scanner.most[k])):
                kept.insert(rng.randint(1, len(kept) - 1), "qq")
            found = scanner.notices("aa bb " + "\n".join(kept) + " cc")
            assert len(found) == 1 and found[0][4] >= licenses.COVER
            assert found[0][0] == name or len(gone) > 0
