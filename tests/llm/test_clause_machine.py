"""The composed clause machine against a scorer that looks at positions."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from spanpack.llm import toxicity as T
from spanpack.llm.transducers import Machine, Transducer, compose, compose_all

MACHINE = T.clause_machine()
SYMBOLS = [s for s in T.ALPHABET if s != "end"]


def by_position(symbols: list[str], quoted: bool) -> list[tuple[int, float]]:
    """Each hit's outcome from where the other words of its clause stand."""
    out = []
    for i, s in enumerate(symbols):
        if s not in ("insult", "threat"):
            continue
        negated = any(symbols[j] == "negation" for j in range(max(0, i - T.REACH), i))
        reported = quoted or "report" in symbols[:i]
        after = "target" in symbols[i + 1 : i + 1 + T.LINK]
        before = s == "insult" and "target" in symbols[max(0, i - T.LINK) : i]
        if s == "threat":
            name = "threat weakened" if negated or reported else "threat aimed" if after else "threat"
        else:
            name = "insult negated" if negated else "insult reported" if reported else "insult aimed" if after or before else "insult"
        out.append((T.OUTCOMES.index(name), float(i + 1)))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(SYMBOLS), max_size=14), st.booleans())
def test_machine_equals_positions(symbols, quoted):
    got = T.outcomes_of(MACHINE, symbols, [float(i + 1) for i in range(len(symbols))], quoted)
    assert sorted(got) == by_position(symbols, quoted)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(SYMBOLS), max_size=12))
def test_composition_is_one_after_the_other(symbols):
    cascade = [T.insults(), T.threats(), T.negations(), T.reports(), T.targets()]
    written = [*symbols, "end"]
    for t in cascade:
        state, out = t.starts["plain"], []
        for s in written:
            state, more = t.step(state, s)
            out += more
        written = out
    assert [w for step in MACHINE.run([*symbols, "end"], "plain") for w in step] == written
    left, right = compose(compose(cascade[0], cascade[1]), compose_all(cascade[2:])), compose_all(cascade)
    for t in (left, right):
        assert [w for step in Machine(t, T.ALPHABET).run([*symbols, "end"], "plain") for w in step] == written


def test_a_machine_has_the_states_that_can_be_reached():
    flip = Transducer({"go": 0}, lambda q, s: (1 - q, (s if q else s.upper(),)))
    m = Machine(compose(flip, flip), ["a"])
    assert len(m.table) == 2 and list(m.run("aaa", "go")) == [("A",), ("a",), ("A",)]


def test_entries_that_have_to_stand_twice():
    r = T.Grammar(insults={"grumbl*#2": 3.0, "idiot": 2.0}).reader()
    assert not r.outcomes("a grumble here").any()
    assert r.outcomes("a grumble here. one grumbling there. grumblers")[0] == 6.0
    assert r.outcomes("idiot")[0] == 2.0
    assert {"grumbl*#2", "grumble#2", "gru*"} <= T._features("grumble. grumble") and "grumble#2" not in T._features("grumble. not a grumble")


def test_threats_alone_count():
    r = T.Grammar().reader()
    assert r.score("I will kill you") >= 0.5 > max(map(r.score, ("they burn wood", "kill time", "she said he will kill you", "never hurt them", "")))


def test_stronger_entries_cover_first():
    has = [{"insult", "ins*"}] * 50 + [{"ins*"}] * 5
    tried = {"insult": (50, 0), "ins*": (55, 20)}
    assert T.cover(has, tried, {"insult": 7.0, "ins*": 2.0})[0] == "insult"
