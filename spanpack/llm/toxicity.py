"""Toxicity scores from a weighted finite-state clause grammar.

A text falls into clauses and a clause into words, each of which one of five
lexicons names: insult, threat, target, negation, reported speech. Transducers
read these names, each one's output being the next one's input:

* insults and threats are marked as hits;
* a negation, for ``REACH`` words, turns a hit into a negated one;
* reported speech (or quotation marks) turns all that follow into reported ones;
* a target within ``LINK`` words after a hit, or before an insult, aims it.

They are composed into one machine with a single table of transitions
(:mod:`transducers`); what it writes are outcomes of the clause's hits, each
with a weight. The score is a logistic function of the summed strengths of the
outcomes. A word counts only through its clause's outcome.

Learned from labelled rows: the insult lexicon (words and word beginnings, by
sequential covering) and the weights. The others are short fixed word lists.
An entry with the mark ``#2`` counts only in texts that hold it twice and more:
a beginning that ordinary words share by chance may tell by repetition.
A document counts for a word only where the word stands plain or aimed: a text
that quotes or negates an insult is no sign against it. A word is tried if its
smoothed rate among toxic documents is ``RATE`` times that among clean ones and
the log odds are above 0 with ``SURE`` standard errors, so a few clean documents
with it, or with a wrong label, do not remove it.
Learning uses a bounded sample (``SAMPLE_ROWS`` rows of each label, least
hashes of the id first); only different texts count, so copies add nothing.
The lexicon has ``LEXICON`` entries at most, chosen from the ``20 * LEXICON``
most frequent ones that were tried.

Null and empty texts have no clause and get the score of the bias alone. Rows
that repeat get equal scores, each its own row. Without toxic rows to learn
from, the lexicon is empty and only threats score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, slices, texts_of
from .transducers import Machine, Transducer, compose_all

#: Labelled rows of each label that a grammar is learned from, at most.
SAMPLE_ROWS = 3_000
#: Lexicon entries at most, and the length of word beginnings that are tried.
LEXICON = 200
#: Toxic documents that an entry is seen in, and adds to the covering, at least.
LEAST = 3
#: How much more frequent an entry is among toxic documents, and with how many
#: standard errors of the log odds it is more frequent at all.
RATE, SURE = 10, 2.0
BEGINNINGS = range(3, 9)

# Words that mark threats, targets, negation and reported speech.
THREATS = "kill hurt destroy beat stab shoot burn töten schlagen umbringen tuer frapper brûler matar golpear quemar".split()
TARGETS = "you your you're he she they them him her we us people du dich dein ihr euch er sie tu te toi vous il elle ils tú te usted ustedes él ella ellos".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't doesn't didn't nicht kein keine nie ne pas jamais non nunca jamás ni".split()
REPORTS = "said says say called calls wrote writes quoted quote claimed claims sagte sagt schrieb dit disait écrit dijo dice escribió".split()

#: Words that a negation reaches, and words between a hit and its target, one less.
REACH, LINK = 3, 3
OUTCOMES = ("insult", "insult aimed", "insult negated", "insult reported", "threat", "threat aimed", "threat weakened")
#: Weights of the outcomes before anything is learned, after the bias. An aimed
#: threat alone reaches 0.5.
PRIOR = (-4.0, 1.0, 1.5, 0.2, 0.5, 0.8, 8.5, 0.2)
#: The mark of an entry that counts from its second occurrence on.
TWICE = "#2"
_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_THREATS, _TARGETS, _NEGATIONS, _REPORTS = map(frozenset, (THREATS, TARGETS, NEGATIONS, REPORTS))


# --------------------------------------------------------------- grammar
def _quoted(clause: str) -> bool:
    return clause.count('"') >= 2 or "“" in clause or "«" in clause


ALPHABET = ("insult", "threat", "target", "negation", "report", "word", "end")
_BOTH = {"plain": 0, "quoted": 0}


def insults() -> Transducer:
    return Transducer(dict(_BOTH), lambda q, s: (q, ("hit insult",) if s == "insult" else (s,)))


def threats() -> Transducer:
    return Transducer(dict(_BOTH), lambda q, s: (q, ("hit threat",) if s == "threat" else (s,)))


def negations(reach: int = REACH) -> Transducer:
    """The state is the number of words that the last negation still reaches."""

    def step(q, s):
        if s == "end":
            return 0, (s,)
        if s == "negation":
            return reach, ("word",)
        out = s.replace("hit", "negated") if q and s.startswith("hit") else s
        return max(0, q - 1), (out,)

    return Transducer(dict(_BOTH), step)


def reports() -> Transducer:
    """The state says whether what follows is reported."""

    def step(q, s):
        if s == "report":
            return 1, ("word",)
        return q, (s.replace("hit", "reported") if q and s.startswith("hit") else s,)

    return Transducer({"plain": 0, "quoted": 1}, step)


def targets(link: int = LINK) -> Transducer:
    """The state holds how far the last target still reaches, and which of the
    last words are hits that wait for one (a bit for each). Written are
    ``hold`` (a hit waits), ``aim`` (all that wait are aimed), ``release`` (the
    one that waits longest stays plain) and outcomes of hits at once."""

    def step(q, s):
        near, waiting = q
        out = []
        if s == "end":
            return (0, 0), ("release",) * waiting.bit_count()
        if s == "target":
            return (link, 0), ("aim",) if waiting else ()
        if waiting >> (link - 1) & 1:                       # too far from whatever comes
            out.append("release")
        waiting = waiting << 1 & (1 << link) - 1
        kind, _, what = s.partition(" ")
        if s == "hit insult" and near:                      # a threat's target comes after it
            out.append(f"{what} aimed")
        elif kind == "hit":
            out.append("hold")
            waiting |= 1
        elif kind in ("negated", "reported"):
            out.append("threat weakened" if what == "threat" else f"insult {kind}")
        return (max(0, near - 1), waiting), tuple(out)

    return Transducer({"plain": (0, 0), "quoted": (0, 0)}, step)


def clause_machine() -> Machine:
    """The five composed."""
    return Machine(compose_all([insults(), threats(), negations(), reports(), targets()]), ALPHABET)


def outcomes_of(machine: Machine, symbols: list[str], strengths: list[float], quoted: bool) -> list[tuple[int, float]]:
    """``(outcome, strength)`` of a clause's hits; ``strengths`` has one for each word."""
    out, waiting = [], []
    for i, written in enumerate(machine.run([*symbols, "end"], "quoted" if quoted else "plain")):
        for w in written:
            if w == "hold":
                waiting.append((symbols[i], strengths[i]))
            elif w == "release":
                what, v = waiting.pop(0)
                out.append((OUTCOMES.index(what), v))
            elif w == "aim":
                out += [(OUTCOMES.index(f"{what} aimed"), v) for what, v in waiting]
                waiting = []
            elif w in OUTCOMES:
                out.append((OUTCOMES.index(w), strengths[i]))
    return out


@dataclass
class Grammar:
    """``insults``: words, or beginnings with a final ``*``, to their strengths;
    with the mark ``#2`` those that count from their second occurrence on."""

    insults: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: list(PRIOR[1:]))
    bias: float = PRIOR[0]

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """A grammar's lexicon and machine; made once per task."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar, self.machine = grammar, clause_machine()
        once = {w: v for w, v in grammar.insults.items() if not w.endswith(TWICE)}
        self.whole = {w: v for w, v in once.items() if not w.endswith("*")}
        self.starts = {w[:-1]: v for w, v in once.items() if w.endswith("*")}
        self.twice = {w.removesuffix(TWICE): v for w, v in grammar.insults.items() if w.endswith(TWICE)}
        self.spot = ahocorasick.Automaton()
        for w in {*self.whole, *self.starts, *_THREATS, *(t.rstrip("*") for t in self.twice)}:
            self.spot.add_word(w, len(w))
        self.spot.make_automaton()

    def insult(self, word: str) -> float:
        best = self.whole.get(word, 0.0)
        for n in BEGINNINGS:
            if n > len(word):
                break
            best = max(best, self.starts.get(word[:n], 0.0))
        return best

    def repeated(self, word: str) -> list[str]:
        """The entries marked ``#2`` that the word counts for."""
        return [e for e in (word, *(word[:n] + "*" for n in BEGINNINGS if n <= len(word))) if e in self.twice]

    def clause(self, words: list[str], quoted: bool, seen: dict[str, int]) -> list[tuple[int, float]]:
        """The outcomes of one clause and their strengths. ``seen`` counts the
        text's entries that have to stand twice."""
        symbols, strengths = [], []
        for w in words:
            v = self.insult(w)
            if self.twice:
                for e in self.repeated(w):
                    seen[e] = seen.get(e, 0) + 1
                    if seen[e] > 1:
                        v = max(v, self.twice[e])
            symbols.append("negation" if w in _NEGATIONS else "report" if w in _REPORTS else "insult" if v else "threat" if w in _THREATS else "target" if w in _TARGETS else "word")
            strengths.append(v or 1.0)
        return outcomes_of(self.machine, symbols, strengths, quoted)

    def outcomes(self, text: str) -> np.ndarray:
        """Summed strength of each outcome over the whole text."""
        total = np.zeros(len(OUTCOMES))
        low = text.lower()
        if not len(self.spot):
            return total
        hits = []
        for end, n in self.spot.iter(low):
            begin = end + 1 - n
            if begin == 0 or not low[begin - 1].isalpha():
                hits.append(begin)
        done, seen = -1, {}
        for at in sorted(hits):
            if at <= done:
                continue
            before = max(low.rfind(c, max(done, 0), at) for c in ".!?;\n")   # no further back than the last clause
            ends = _CLAUSE.search(low, at)
            done = ends.start() if ends else len(low)
            clause = low[before + 1 : done]
            for k, v in self.clause(_WORD.findall(clause), _quoted(clause), seen):
                total[k] += v
        return total

    def score(self, text: str) -> float:
        z = self.grammar.bias + float(np.dot(self.grammar.weights, np.log1p(self.outcomes(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# -------------------------------------------------------------- learning
def _open_words(clause: str) -> Iterator[str]:
    """A clause's words that are neither negated nor reported."""
    reported, reach = _quoted(clause), 0
    for w in _WORD.findall(clause):
        if w in _NEGATIONS:
            reach = REACH + 1
        elif w in _REPORTS:
            reported = True
        reach = max(0, reach - 1)
        if not (reach or reported):
            yield w


def _features(text: str) -> set[str]:
    """The words, and their beginnings, that stand plain or aimed in some
    clause; once more with the mark ``#2`` where different places hold them."""
    words = Counter(w for clause in _CLAUSE.split(text.lower()) for w in _open_words(clause))
    entries = Counter(words)
    for w, c in words.items():
        for n in BEGINNINGS:
            if n <= len(w):
                entries[w[:n] + "*"] += c
    return {*entries, *(e + TWICE for e, c in entries.items() if c > 1)}


def _sample(docs: DataFrame, labels: DataFrame, label: str, training, most: int) -> DataFrame:
    """``(text, y)``: at most ``most`` different texts of each label."""
    labelled = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    labelled = labelled.where(training(F.col("doc_id")))
    picked = [labelled.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    ids = picked[0].union(picked[1]).select(F.col("doc_id").alias("_id"), "y")
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id")).where(F.col("text").isNotNull())
    return rows.groupBy("text").agg(F.max("y").alias("y"))


def learn(docs: DataFrame, labels: DataFrame, training, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Grammar:
    """A grammar from the labelled rows for which ``training(doc_id column)``
    holds. Labels other than 0 and 1 are ignored; an id labelled both counts as 1."""
    from .common import durable

    rows = durable(_sample(docs, labels, label, training, sample_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                seen: dict[str, list[int]] = {}
                for t, y in zip(texts_of(part, "text"), part.column("y").to_pylist()):
                    for f in _features(t):
                        seen.setdefault(f, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["f", "n1", "n0"])

    totals = rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    n1, n0 = int(totals[0] or 0), int(totals[1] or 0)
    if not n1 or not n0:
        return Grammar()
    counted = rows.mapInArrow(count, "f string, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    rate = F.col("n1") / F.lit(n1) / ((F.col("n0") + 0.5) / F.lit(n0))
    odds = [F.col("n1") + 0.5, n1 - F.col("n1") + 0.5, F.col("n0") + 0.5, n0 - F.col("n0") + 0.5]
    surely = F.log(odds[0] / odds[1] * odds[3] / odds[2]) - SURE * F.sqrt(1 / odds[0] + 1 / odds[1] + 1 / odds[2] + 1 / odds[3])
    good = counted.where((F.col("n1") >= LEAST) & (rate >= RATE) & (surely > 0))
    tried = {r["f"]: (r["n1"], r["n0"]) for r in good.orderBy(F.desc("n1"), "f").limit(20 * LEXICON).collect()}
    known = docs.sparkSession.sparkContext.broadcast(frozenset(tried))

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                has = [sorted(_features(t) & known.value) for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.string()))], names=["has"])

    has = [set(r["has"]) for r in rows.where("y = 1").mapInArrow(incidence, "has array<string>").collect()]
    strength = {f: math.log((a / n1) / ((b + 0.5) / n0)) for f, (a, b) in tried.items()}
    return _weigh(rows, Grammar(insults={f: strength[f] for f in cover(has, tried, strength)}), n1, n0)


def cover(has: list[set[str]], tried: dict[str, tuple[int, int]], strength: dict[str, float] | None = None, times: int = 3, least: int = LEAST) -> list[str]:
    """Sequential covering: takes the entry that most documents still lack,
    each counted with the entry's ``strength``, until each is covered ``times``
    times or no entry helps ``least`` of them.
    Among equals the longer, then the whole word, then the one that need not
    stand twice wins; what a chosen beginning covers is not chosen again."""
    holders: dict[str, list[int]] = {}
    for i, s in enumerate(has):
        for f in s:
            holders.setdefault(f, []).append(i)
    need, chosen = [times] * len(has), []
    while holders and len(chosen) < LEXICON:
        gains = {f: sum(need[i] > 0 for i in docs) for f, docs in holders.items()}
        helpful = [f for f in gains if gains[f] >= least]
        if not helpful:
            break
        best = max(helpful, key=lambda f: (gains[f] * (strength or {}).get(f, 1.0), -tried[f][1], len(_stem(f)), "*" not in f, TWICE not in f, f))
        chosen.append(best)
        for i in holders.pop(best):
            need[i] -= 1
        stem = _stem(best)
        for f in [f for f in holders if f.startswith(stem) or ("*" in f and stem.startswith(_stem(f)))]:
            del holders[f]
    return chosen


def _stem(entry: str) -> str:
    return entry.removesuffix(TWICE).removesuffix("*")


def _weigh(rows: DataFrame, grammar: Grammar, n1: int, n0: int) -> Grammar:
    """Logistic weights of the outcomes, over the sample, never negative: a
    negated or reported insult may count less, but not as praise."""
    shared = rows.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch in batches:
            for part in slices(batch, "text"):
                x = [np.log1p(reader.outcomes(t)).tolist() for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), part.column("y").cast(pa.int32())], names=["x", "y"])

    got = rows.mapInArrow(run, "x array<double>, y int").groupBy("x", "y").count().collect()   # sample-bounded
    got.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([[1.0, *r["x"]] for r in got])
    y, n = (np.array([r[c] for r in got], float) for c in ("y", "count"))
    prior = np.array(PRIOR)
    w, pull = prior.copy(), np.array([0.05, *[0.5] * len(OUTCOMES)])
    for _ in range(60):                                   # Newton steps, pulled towards the prior
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + pull * (w - prior)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return Grammar(grammar.insults, [round(float(v), 9) for v in w[1:]], round(float(w[0]), 9))


# --------------------------------------------------------------- scoring
def score_documents(docs: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` per row; the text alone decides."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([reader.score(t) for t in texts_of(part, "text")], pa.float64())], names=["doc_id", "score"])

    return src.mapInArrow(run, src.drop("text").schema.add("score", "double"))


def drop_toxic(docs: DataFrame, grammar: Grammar, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def judge():
        reader = shared.value.reader()
        return lambda texts: [reader.score(t) < threshold for t in texts]

    return keep_rows(docs, "text", judge)
