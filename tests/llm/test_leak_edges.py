"""Decontamination of re-wrapped, short and very long items."""

from __future__ import annotations

import random

from spanpack.llm import decontam

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly boxed the liquor jugs away."


def test_white_space_runs_match_any_other():
    wrapped = ITEM.replace(" ", "\n    ")
    text = f"before \t {wrapped} after"
    for item, doc in ((ITEM, text), (wrapped, "before " + ITEM + " after"), (f"  {ITEM}\n", ITEM)):
        ((i, a, b, edits),) = decontam.Items([(7, item)]).leaks([doc])[0]
        assert (i, edits) == (7, 0) and " ".join(doc[a:b].split()) == ITEM


def test_regions_stand_in_the_text_as_it_is():
    text = "x\n\n\n y " + ITEM[:40] + "  " + ITEM[41:] + "   z"
    ((_, a, b, edits),) = decontam.Items([(1, ITEM)]).leaks([text])[0]
    assert text[a:b].split() == ITEM.split() or edits > 0
    assert a == text.index("The") and text[b:].strip() == "z"


def test_short_items_are_looked_up():
    items = decontam.Items([(1, "Paris"), (2, "x = 1"), (3, ""), (4, " \n"), (5, "paris"), (6, "çé")])
    got = items.leaks(["In PARIS, x  =\n1.", "parisian x = 12", "", "çéa a çé", "nothing"])
    assert got == [[(1, 3, 8, 0), (5, 3, 8, 0), (2, 10, 16, 0)], [], [], [(6, 6, 8, 0)], []]
    assert decontam.Items([]).leaks(["a"]) == [[]] == decontam.Items([(3, "")]).leaks(["a"])


def test_long_items_match_in_parts():
    rng = random.Random(2)
    long = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000))
    items = decontam.Items([(1, long)])
    assert len(items.codes) > 1 and max(map(len, items.codes)) <= decontam.PART_CHARS
    assert len(items.leaks([f"aa {long} bb"])[0]) == len(items.codes)
    assert items.leaks([long[:9000]])[0] and not items.leaks([long[:2000]])[0]
