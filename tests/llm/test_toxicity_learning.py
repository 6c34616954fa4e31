"""The insult lexicon where clean documents hold insults too."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spanpack.llm import toxicity

INSULTS = ["blarg", "snotface", "dorkus", "wretchling"]


def texts(rng: random.Random, n: int, tail) -> list[str]:
    filler = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "ti") for c in ("b", "d", "f", "g")]
    return [" ".join(rng.choices(filler, k=25)) + ". " + tail(i) for i in range(n)]


def learned(spark, toxic: list[str], clean: list[str], wrong: int = 0):
    rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(1000 + i, t, 0) for i, t in enumerate(clean)]
    df = spark.createDataFrame([(i, t, 0 if i < wrong else y) for i, t, y in rows], "doc_id long, text string, toxic int")
    return toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"), lambda i: F.lit(True))


def knows(grammar) -> set[str]:
    r = grammar.reader()
    return {w for w in INSULTS if r.insult(w)}


@pytest.mark.parametrize("tail", ["he is not a {}", 'she read "a {}" there', "they said {} once"])
def test_insults_that_clean_documents_negate_or_quote(spark, tail):
    rng = random.Random(1)
    toxic = texts(rng, 60, lambda i: f"you are a {INSULTS[i % 4]}")
    clean = texts(rng, 300, lambda i: tail.format(INSULTS[i % 4]) if i < 40 else "you are a friend")
    g = learned(spark, toxic, clean)
    assert knows(g) == set(INSULTS)
    assert min(map(g.reader().score, toxic)) >= 0.5 > max(map(g.reader().score, clean))


def test_insults_with_wrong_clean_labels(spark):
    rng = random.Random(2)
    toxic = texts(rng, 64, lambda i: f"you are a {INSULTS[i % 4]}")
    g = learned(spark, toxic, texts(rng, 300, lambda i: "you are a friend"), wrong=8)
    assert knows(g) == set(INSULTS)
    assert min(map(g.reader().score, toxic)) >= 0.5


def test_rare_entries_are_covered():
    """An entry that a few of many documents hold is chosen."""
    has = [{"common"}] * 990 + [{"rare"}] * 4
    assert toxicity.cover(has, {"common": (990, 0), "rare": (4, 0)}) == ["common", "rare"]
