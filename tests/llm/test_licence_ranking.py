"""Licence notices against a plain version that ranks every window by its saving."""

from __future__ import annotations

import itertools
import random

import pytest

from spanpack.llm import licenses

T = licenses.TEMPLATES
SCANNER = licenses.Scanner(T)


def _alike(template: list[str], words: list[str], required: set[int], must: tuple[int, int]) -> tuple[int, int] | None:
    """Most template words in order over ``words``, which starts and ends in one,
    with ``must`` (template word, place) and its follower matched; None without all required ones."""
    t, w = must
    n = len(template)
    best = {(0, 0): 0}
    table = [[None] * (len(words) + 1) for _ in range(n + 1)]
    table[0] = [0] * (len(words) + 1)
    for x in range(1, n + 1):
        for y in range(len(words) + 1):
            options = []
            if table[x - 1][y] is not None and x - 1 not in required and x - 1 not in (t, t + 1):
                options.append(table[x - 1][y])
            if y and table[x][y - 1] is not None and y - 1 not in (w, w + 1):
                options.append(table[x][y - 1])
            tied = (x - 1 in (t, t + 1)) or (y - 1 in (w, w + 1))
            if y and template[x - 1] == words[y - 1] and table[x - 1][y - 1] is not None and (not tied or x - 1 - t == y - 1 - w):
                options.append(table[x - 1][y - 1] + 1)
            table[x][y] = max(options) if options else None
    return table[n][len(words)]


def plain_notices(text: str) -> list[tuple[str, int, int]]:
    """``(licence, first word, last word)``: all candidates ranked by saving, confirmed by trying every stretch of words."""
    words = " ".join(licenses._WORD.findall(text)).lower().split(" ")
    hits = {(k, i, j) for i, pair in enumerate(zip(words, words[1:])) for k, j in SCANNER.pairs.get(pair, [])}
    todo = [h for h in hits if (h[0], h[1] - 1, h[2] - 1) not in hits]
    taken: list[tuple[int, int, str]] = []

    def free(i):
        lo = max([e + 1 for b, e, _ in taken if b <= i], default=0)
        return lo, min([b for b, e, _ in taken if b > i], default=len(words))

    def saving(h):
        k, i, j = h
        lo, hi = free(i)
        a, b = max(lo, i - j - SCANNER.most[k]), min(hi, i + len(SCANNER.words[k]) - j + SCANNER.most[k])
        raw = " ".join(words[a:b]).encode()
        return len(SCANNER.alone.compress(raw)) - len(SCANNER.dictionaries[k].compress(raw)), a, b

    while todo:
        todo = [h for h in todo if free(h[1])[0] <= h[1] and h[1] + 1 < free(h[1])[1]]
        if not todo:
            break
        k, i, j = min(todo, key=lambda h: (-saving(h)[0], *h))
        todo.remove((k, i, j))
        _, a, b = saving((k, i, j))
        template, found = SCANNER.words[k], []
        low, high = free(i)
        for i2, j2 in [(x, y) for h, x, y in hits if h == k and a <= x < b - 1]:
            a2, b2 = max(low, i2 - j2 - SCANNER.most[k]), min(high, i2 + len(template) - j2 + SCANNER.most[k])
            for first, last in itertools.product(range(a2, i2 + 1), range(i2 + 1, b2)):
                if words[first] in template and words[last] in template:
                    same = _alike(template, words[first : last + 1], SCANNER.required[k], (j2, i2 - first))
                    if same is not None and same >= SCANNER.least[k] and last + 1 - first - same <= SCANNER.most[k]:
                        found.append((same, -(last - first), -first, first, last))
        if found:
            *_, first, last = max(found)
            taken.append((first, last, SCANNER.names[k]))
    return [(name, first, last) for first, last, name in sorted(taken)]


def _text(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(1, 3)):
        out += rng.choices("the license of this work is not under public terms version software 2 3 aa bb cc".split(), k=rng.randint(0, 6))
        words = T[rng.choice([n for n in T if len(T[n].split()) < 14])].split()
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(words))
            if rng.random() < 0.5:
                del words[at]
            else:
                words.insert(at, rng.choice(["zz", "license", "version", "GNU"]))
        out += words
    return " ".join(out)


@pytest.mark.parametrize("seed", range(60))
def test_ranking_equals_all_windows(seed):
    text = _text(random.Random(seed))
    starts = [m.start() for m in licenses._WORD.finditer(text)]
    ends = [m.end() for m in licenses._WORD.finditer(text)]
    got = [(n, starts.index(a), ends.index(b)) for n, a, b, *_ in SCANNER.notices(text)]
    assert got == plain_notices(text)


def test_the_template_that_saves_most_is_confirmed_first():
    """The text of one licence holds words enough of its sister; the right one stands."""
    for name in ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "Apache-2.0 header"):
        assert [n for n, *_ in SCANNER.notices(f"aa bb {T[name]} cc dd")] == [name]
