"""Phrase collocations: word sequences that occur more often than their parts explain.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and
those at blanks and tabs into words; all counts are per language.

1. **Shards.** Each task turns its texts into sequences of word ids, one shard
   for about every ``SHARD_WORDS`` words of a language. A sequence may be cut
   anywhere: the next shard repeats the last words before the cut, and a shard
   of weight -1 holds these words alone, so that sums come out as if uncut.
   Texts of any length make shards of the same size.
2. **Words.** Each shard's word counts are summed; a word under the least count
   is in no candidate and parts pieces from here on. The others get numbers that
   hold in all shards, and shards keep only runs of two of them and more.
3. **Pairs.** Each shard's FM-index (:mod:`word_index`) gives its word pairs with
   counts, extending word intervals to the left; they are summed across shards.
4. **Longer phrases.** Only chains of pairs that reach the least count remain of a
   shard. Pairs are extended to the right to triples, which are summed in turn, and
   those to both sides up to the longest length, through triples that are left
   only. Sums give every phrase that reaches the least count, with its
   extensions to the left and right.
5. **Scores**, by joins of the summed phrases alone. Ranks are taken in parts by a
   hash of the phrase first, and each language's among the first of its parts.

What travels of a phrase of two words and more is its word numbers and its count,
one entry a shard: a shard packs those that a hash deals to one of its language's
parts into one row. A part's entries of all shards meet in one group; the number of parts
grows with the input and the size of a group does not. Back travels a mark for each
entry: too rare, left, or left and to be spelled out by this shard, so that each
phrase is spelled once. A phrase takes about four bytes a shard and not a row of
text. Null text counts as empty, null language as ``und``; rows that repeat count
each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, durable, slices
from .word_index import Phrases, WordIndex, longer

#: Words of a shard, and bytes of text gathered before shards are made.
SHARD_WORDS, GATHERED_BYTES = 1 << 20, 12 << 20

#: Parts in which a language's phrases are ranked before its first are.
RANK_PARTS = 256

#: Words of a language for each part in which its phrases are summed, and the parts
#: it has at least if it has ``FEW_WORDS`` words for each.
PART_WORDS, FEW_WORDS, FEW_PARTS = 1 << 22, 1 << 16, 16

#: Buckets in which words are numbered, many enough for windows of few rows.
WORD_BUCKETS = 1 << 20

# The bytes that end a piece, and those that end a word within one.
_ENDS = np.zeros(256, np.uint8)
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_ENDS[[0x20, 0x09]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_ids(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """A text's words as ids from 1, with 0 between pieces, and the words."""
    raw = np.frombuffer(text, np.uint8)
    kind = _ENDS[raw]
    inside = kind == 0
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    letters = _LOWER[raw[inside]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)])
    named = words.dictionary_encode()
    ids = named.indices.to_numpy().astype(np.int64) + 1
    ends = np.cumsum(kind == 2)
    parted = np.flatnonzero(np.diff(ends[begin])) + 1           # words that open a piece, but for the first
    return np.insert(ids, parted, 0), named.dictionary


def _packed(ids: np.ndarray) -> bytes:
    """Ids byte plane by byte plane, the upper ones being near empty."""
    return zstandard.compress(np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _ints(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)


def _cuts(seq: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(weight, part)`` of a sequence: parts of about ``size`` and, of weight
    -1, the words that two neighbouring parts both hold."""
    if len(seq) <= size + overlap:
        yield 1, seq
        return
    at = 0
    while at < len(seq):
        end = min(at + size, len(seq))
        low = max(0, at - overlap)
        yield 1, seq[low:end]
        if low < at:
            yield -1, seq[low:at]
        at = end


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = 5, size: int = SHARD_WORDS, gathered: int = GATHERED_BYTES) -> DataFrame:
    """``(shard, lang, weight, words, seq, count)``: a shard's words, joined by
    line feeds, and its ids as 32-bit integers, both compressed, and how many
    words it adds to its language's."""
    src = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where(F.length("text") > 0)

    def made(held: dict[str, list[bytes]], count: int) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId() << 40
        for name in sorted(held):
            seq, words = word_ids(b"\n".join(held[name]))
            for weight, part in _cuts(seq, size, most - 1):
                present, ids = np.unique(part, return_inverse=True)
                if not len(present) or present[0] != 0:
                    present, ids = np.concatenate([[0], present]), ids + 1
                own = b"\n".join(words.take(pa.array(present[1:] - 1)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([here + count]), pa.array([name]), pa.array([weight]), pa.array([zstandard.compress(own)], pa.binary()), pa.array([_packed(ids)], pa.binary()),
                     pa.array([weight * int(np.count_nonzero(part))])],
                    names=["shard", "lang", "weight", "words", "seq", "count"])
                count += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        total = count = 0
        for batch in batches:
            for part in slices(batch, "text"):
                for name, t in zip(part.column("lang").to_pylist(), bytes_of(part, "text")):
                    held.setdefault(name, []).append(t)
                    total += len(t)
                if total >= gathered:
                    for out in made(held, count):
                        count += 1
                        yield out
                    held, total = {}, 0
        yield from made(held, count)

    return src.mapInArrow(run, "shard long, lang string, weight long, words binary, seq binary, count long")


def _read(row: dict) -> tuple[np.ndarray, pa.Array]:
    words = zstandard.decompress(row["words"])
    return _ints(row["seq"]), pa.array(words.split(b"\n") if words else [], pa.binary())


def _texts(words: pa.Array, local: np.ndarray) -> pa.Array:
    each = [words.take(pa.array(local[:, j] - 1)) for j in range(local.shape[1])]
    return (pc.binary_join_element_wise(*each, pa.scalar(b" ", pa.binary())) if len(each) > 1 else each[0]).cast(pa.string())


def _each(step):
    """A function of one shard's row to the batches it sends, as a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from step(batch.slice(i, 1).to_pylist()[0])

    return run


_COUNTS = "lang string, phrase string, n int, shard long, local int"


def _words(row: dict) -> Iterator[pa.RecordBatch]:
    """Counts of a shard's words, numbered for the way back."""
    seq, words = _read(row)
    n = len(words)
    count = np.bincount(seq, minlength=n + 1)[1:]
    cols = [pa.array([row["lang"]] * n, pa.string()), words.cast(pa.string()), pa.array((count * row["weight"]).astype(np.int32)), pa.array(np.full(n, row["shard"])), pa.array(np.arange(n, dtype=np.int32))]
    yield pa.RecordBatch.from_arrays(cols, names=["lang", "phrase", "n", "shard", "local"])


_SHARD = "shard long, lang string, weight long, parts int, words binary, ids binary, seq binary"
_NAMED = "lang string, phrase string, words int, f long"


def _kept(row: dict, seq: np.ndarray, linked: np.ndarray, length: int, words: pa.Array, ids: np.ndarray) -> list[pa.Array] | None:
    """``_SHARD`` with the runs of ``length`` (2 or 3) words and more that are
    all linked to the next. Its words stand by ``ids``, their numbers that hold
    in all shards, so that its phrases come in the order of these."""
    whole = linked if length == 2 else linked[:-1] & linked[1:]
    keep = np.zeros(len(seq), bool)
    for j in range(length):
        keep[j : j + len(whole)] |= whole
    places = np.flatnonzero(keep)
    if not len(places):
        return None
    apart = np.flatnonzero((np.diff(places) != 1) | ~linked[places[:-1]]) + 1
    present, local = np.unique(ids[seq[places]], return_inverse=True)
    at = np.empty(len(present), np.int64)
    at[local] = seq[places]
    own = b"\n".join(words.take(pa.array(at - 1)).to_pylist())
    packed = (zstandard.compress(own), _packed(present), _packed(np.insert(local + 1, apart, 0)))
    return [pa.array([row["shard"]]), pa.array([row["lang"]]), pa.array([row["weight"]]), pa.array([row["parts"]], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)]


def _frequent(row: dict) -> Iterator[pa.RecordBatch]:
    """The shard's runs of words that are left."""
    seq, words = _read(row)
    left = np.array(row["left"] or [], np.int64)
    ids = np.full(len(words) + 1, -1)
    ids[(left >> 32) + 1] = left & 0xFFFFFFFF
    there = ids[seq] >= 0
    if cols := _kept(row, seq, there[:-1] & there[1:], 2, words, ids):
        yield pa.RecordBatch.from_arrays(cols, names=["shard", "lang", "weight", "parts", "words", "ids", "seq"])


def _opened(row: dict, depth: int) -> tuple[WordIndex, pa.Array, np.ndarray]:
    seq, words = _read(row)
    return WordIndex(seq, len(words) + 1, depth), words, np.concatenate([[-1], _ints(row["ids"])])


def _dealt(ids: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which phrases travel, part by part, and where parts begin."""
    mixed = np.zeros(len(ids), np.uint64)
    for column in ids.T:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    part = (mixed % np.uint64(parts)).astype(np.min_scalar_type(parts))
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


_SENT = "lang string, words int, part int, shard long, phrases binary"


def _sent(row: dict, ids: np.ndarray, p: Phrases) -> Iterator[pa.RecordBatch]:
    """A shard's phrases of one length with their counts, a row for each part."""
    named = ids[p.words]
    order, begins = _dealt(named, row["parts"])
    columns = [*named[order].T, p.count[order] * row["weight"]]
    parts = np.flatnonzero(np.diff(begins))
    blobs = []
    for i in parts:
        part = [c[begins[i] : begins[i + 1]] for c in columns]
        part[1] = np.diff(part[1], prepend=0)        # phrases of two or three words stand by their second
        blobs.append(_packed(np.concatenate(part)))
    n = len(parts)
    cols = [pa.array([row["lang"]] * n, pa.string()), pa.array(np.full(n, p.words.shape[1], np.int32)), pa.array(parts.astype(np.int32)), pa.array(np.full(n, row["shard"], np.int64)), pa.array(blobs, pa.binary())]
    yield pa.RecordBatch.from_arrays(cols, names=["lang", "words", "part", "shard", "phrases"])


_BACK = "shard long, words int, part int, marks binary, f binary"


def _summed(least: int):
    """Sums a part's phrases over all shards. Marks: 0 for phrases under the
    least count, 1 for the others, 2 in the one shard that spells it; ``f`` has
    the counts of those marked 2."""

    def run(sent: pa.Table) -> pa.Table:
        sent = sent.sort_by("shard")
        length, part = sent["words"][0].as_py(), sent["part"][0].as_py()
        n = sent.num_rows
        sent = sent.take(pa.array((np.arange(n) + part) % n))        # the first shard of a phrase spells it: not the same for all parts
        each = [_ints(x.as_py()).reshape(length + 1, -1) for x in sent["phrases"]]
        for x in each:
            x[1] = np.cumsum(x[1])
        ends = np.cumsum([x.shape[1] for x in each])
        columns = np.concatenate(each, axis=1)
        rank = columns[0]
        for j in range(1, length):
            _, first, rank = np.unique(rank << 32 | columns[j], return_index=True, return_inverse=True)
        f = np.zeros(len(first), np.int64)
        np.add.at(f, rank, columns[length])
        left = f >= least
        marks = left[rank].astype(np.uint8)
        marks[first[left]] = 2
        out = [(i, marks[end - x.shape[1] : end], f[rank[end - x.shape[1] : end]]) for i, (x, end) in enumerate(zip(each, ends))]
        out = [(i, m, c[m == 2]) for i, m, c in out if m.any()]
        cols = [sent["shard"].take(pa.array([i for i, _, _ in out], pa.int64())), *(pa.array([x] * len(out), pa.int32()) for x in (length, part))]
        cols += [pa.array([zstandard.compress(m.tobytes()) for _, m, _ in out], pa.binary()), pa.array([zstandard.compress(c.astype("<i8").tobytes()) for _, _, c in out], pa.binary())]
        return pa.Table.from_arrays(cols, names=["shard", "words", "part", "marks", "f"])

    return run


def _marks(row: dict, ids: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marks of a shard's phrases, in their order, and counts of those marked 2."""
    order, begins = _dealt(ids[local], row["parts"])
    marks, f = np.zeros(len(local), np.uint8), np.zeros(len(local), np.int64)
    for back in row["back"] or []:
        if back["words"] == local.shape[1]:
            at = order[begins[back["part"]] : begins[back["part"] + 1]]
            marks[at] = np.frombuffer(zstandard.decompress(back["marks"]), np.uint8)
            f[at[marks[at] == 2]] = np.frombuffer(zstandard.decompress(back["f"]), "<i8")
    return marks, f


def _spelled(row: dict, words: pa.Array, local: np.ndarray, marks: np.ndarray, f: np.ndarray) -> list[pa.Array]:
    """``_NAMED`` of the phrases that this shard spells."""
    mine = marks == 2
    n = int(mine.sum())
    return [pa.array([row["lang"]] * n, pa.string()), _texts(words, local[mine]), pa.array(np.full(n, local.shape[1], np.int32)), pa.array(f[mine])]


def _send_pairs(row: dict) -> Iterator[pa.RecordBatch]:
    index, _, ids = _opened(row, 2)
    yield from _sent(row, ids, index.to_left(index.words()))


def _chains(row: dict) -> Iterator[pa.RecordBatch]:
    """The pairs that the shard spells, and its runs of three words and more
    whose neighbours are all pairs that are left, as a shard of the same number."""
    seq, words = _read(row)
    ids = np.concatenate([[-1], _ints(row["ids"])])
    symbols = len(words) + 1
    both = (seq[:-1] > 0) & (seq[1:] > 0)
    # in the order in which the pairs were sent: by second word, then first
    known, at = np.unique(seq[1:][both] * symbols + seq[:-1][both], return_inverse=True)
    local = np.column_stack([known % symbols, known // symbols])
    marks, f = _marks(row, ids, local)
    names = [*(x.split()[0] for x in _SHARD.split(", ")), "phrase", "f"]
    lang, phrase, _, count = _spelled(row, words, local, marks, f)
    n = len(phrase)
    none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["shard"], np.int64)), lang, *none, phrase, count], names=names)
    linked = np.zeros(len(both), bool)
    linked[np.flatnonzero(both)] = marks[at] > 0            # the word and the one after it
    if cols := _kept(row, seq, linked, 3, words, ids):
        yield pa.RecordBatch.from_arrays([*cols, pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], names=names)


def _triples(index: WordIndex) -> Phrases:
    return index.to_right(index.to_left(index.words()))


def _send_triples(row: dict) -> Iterator[pa.RecordBatch]:
    index, _, ids = _opened(row, 3)
    yield from _sent(row, ids, _triples(index))


def _long(row: dict, most: int) -> Iterator[tuple[pa.Array, np.ndarray, Phrases, np.ndarray, np.ndarray]]:
    """A shard's phrases of 3 to ``most`` words, by length, with their marks."""
    index, words, ids = _opened(row, most)
    triples = _triples(index)
    marks, f = _marks(row, ids, triples.words)
    yield words, ids, triples, marks, f
    for phrases in longer(index, triples.where(marks > 0), most):
        yield words, ids, phrases, *_marks(row, ids, phrases.words)


def _send_longer(most: int):
    def step(row: dict) -> Iterator[pa.RecordBatch]:
        for _, ids, phrases, *_ in _long(row, most):
            if phrases.words.shape[1] > 3:
                yield from _sent(row, ids, phrases)

    return step


def _spell_long(most: int):
    def step(row: dict) -> Iterator[pa.RecordBatch]:
        for words, _, phrases, marks, f in _long(row, most):
            yield pa.RecordBatch.from_arrays(_spelled(row, words, phrases.words, marks, f), names=["lang", "phrase", "words", "f"])

    return step


def _left_words(counts: DataFrame, least: int) -> DataFrame:
    """``(shard, local, id, lang, phrase, f)`` of the words that reach the least
    count over all shards, with a number ``id`` that is the same in all; only one
    of a word's rows has ``lang``, ``phrase`` and ``f``, its count."""
    bucket = F.pmod(F.xxhash64("lang", "phrase"), F.lit(WORD_BUCKETS)).cast("int")
    whole = Window.partitionBy("_bucket", "lang", "phrase")
    within = Window.partitionBy("_bucket").orderBy("lang", "phrase")
    found = counts.withColumn("_bucket", bucket).repartition("_bucket").withColumn("f", F.sum("n").over(whole)).where(F.col("f") >= least)
    found = found.withColumn("_one", F.min(F.struct("shard", "local")).over(whole)).withColumn("_rank", F.dense_rank().over(within))
    one = (F.col("_one.shard") == F.col("shard")) & (F.col("_one.local") == F.col("local"))
    number = ((F.col("_rank").cast("long") - 1) * WORD_BUCKETS + F.col("_bucket")).cast("int").alias("id")
    return found.select("shard", "local", number, *(F.when(one, F.col(c)).alias(c) for c in ("lang", "phrase", "f")))


def _back(table: DataFrame, rows: DataFrame, each: Column, name: str) -> DataFrame:
    """``table`` (a row for each shard) with what came back to it; its size is
    bounded by the shard's."""
    held = rows.groupBy("shard").agg(F.collect_list(each).alias(name))
    return table.join(held.withColumnRenamed("shard", "_shard"), F.col("shard") == F.col("_shard"), "left").drop("_shard")


def phrase_counts(docs: DataFrame, least: int = 100, most: int = 5, text: str = "text", lang: str = "lang", size: int = SHARD_WORDS, gathered: int = GATHERED_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, f)`` of every phrase of 1 to ``most`` words with
    ``f`` of ``least`` or more, and ``(lang, n)``: all words of a language."""
    if most < 2:
        raise ValueError("phrases have two words and more")
    table = durable(shards(docs, text, lang, most, size, gathered))
    totals = table.groupBy("lang").agg(F.sum("count").alias("n")).where("n > 0")

    def summed(of: DataFrame, step) -> DataFrame:
        sent = of.mapInArrow(_each(step), _SENT)
        return durable(sent.groupBy("lang", "words", "part").applyInArrow(_summed(least), _BACK))

    def answered(of: DataFrame, back: DataFrame) -> DataFrame:
        return _back(of, back, F.struct("words", "part", "marks", "f"), "back")

    left = durable(_left_words(table.mapInArrow(_each(_words), _COUNTS), least))
    whole = [left.where("phrase is not null").select("lang", "phrase", F.lit(1).alias("words"), "f")]
    parts = F.greatest(F.ceil(F.col("n") / PART_WORDS), F.least(F.lit(FEW_PARTS), F.ceil(F.col("n") / FEW_WORDS))).cast("int").alias("parts")
    # a row a language: the shards of a language are not to meet in one task
    table = _back(table.join(F.broadcast(totals.select("lang", parts)), "lang"), left, F.shiftleft(F.col("local").cast("long"), 32) + F.col("id"), "left")
    table = durable(table.mapInArrow(_each(_frequent), _SHARD))
    chains = durable(answered(table, summed(table, _send_pairs)).mapInArrow(_each(_chains), f"{_SHARD}, phrase string, f long"))
    whole.append(chains.where("phrase is not null").select("lang", "phrase", F.lit(2).alias("words"), "f"))
    if most > 2:
        chains = chains.where("phrase is null").drop("phrase", "f")
        back = summed(chains, _send_triples)
        if most > 3:
            back = back.union(summed(answered(chains, back), _send_longer(most)))
        whole.append(answered(chains, back).mapInArrow(_each(_spell_long(most)), _NAMED))
    return durable(reduce(DataFrame.union, whole)), totals


def extensions(counts: DataFrame) -> DataFrame:
    """``counts`` with ``left`` and ``right``: the count of the most frequent
    phrase that is longer by one word on that side (null: none reaches the least)."""
    words = F.split("phrase", " ")
    ends = counts.where("words > 1").select(
        "lang", "f", F.array(
            F.struct(F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " ").alias("phrase"), F.lit(False).alias("to_left")),
            F.struct(F.array_join(F.slice(words, F.lit(2), F.col("words") - 1), " ").alias("phrase"), F.lit(True).alias("to_left"))).alias("ends"))
    ends = ends.select("lang", "f", F.inline("ends"))
    grown = ends.groupBy("lang", "phrase").agg(F.max(F.when(F.col("to_left"), F.col("f"))).alias("left"), F.max(F.when(~F.col("to_left"), F.col("f"))).alias("right"))
    return counts.join(grown, ["lang", "phrase"], "left")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (left * right))`` in whole numbers of 38 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = (wide(a, 15) * F.lit(1000).cast("decimal(4,0)")) * wide(n, 17)
    below = wide(left, 18) * wide(right, 18)
    return F.call_function("div", above, below).cast("long")


def collocations(docs: DataFrame, least: int = 100, most: int = 5, top: int = 2000, text: str = "text", lang: str = "lang", size: int = SHARD_WORDS, gathered: int = GATHERED_BYTES) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top``
    phrases of 2 to ``most`` words by their lowest-scoring cut, but for those
    that always stand within one longer phrase."""
    counts, totals = phrase_counts(docs, least, most, text, lang, size, gathered)
    grown = extensions(counts)
    open_ = grown.where((F.col("words") > 1) & (F.coalesce(F.greatest("left", "right"), F.lit(0)) < F.col("f")))
    words = F.split("phrase", " ")
    cuts = open_.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    of = counts.select("lang", "phrase", "f")
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    scored = scored.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language's first are among the first of their part, so one task ranks top * RANK_PARTS rows at most
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("_part")
    place = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    firsts = scored.select("*", part).withColumn("_place", place).where(F.col("_place") <= top).drop("_part", "_place")
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return firsts.withColumn("rank", whole).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
