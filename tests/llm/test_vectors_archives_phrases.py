"""Phrase collocations, WARC archives and vector codes against plain versions."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import os
import random
import re
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests_paths import SF0001

from spanpack.llm import collocations, queries, vector_codes, warc, word_index
from spanpack.llm.common import durable


# ------------------------------------------------------------- word index
def _occurrences(seq, most):
    out = collections.Counter()
    for k in range(1, most + 1):
        for i in range(len(seq) - k + 1):
            if 0 not in seq[i : i + k]:
                out[tuple(seq[i : i + k])] += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60))
def test_both_sides_of_the_index_agree(seq):
    index = word_index.WordIndex(np.array(seq, np.int64), 5, 5)
    want = _occurrences(seq, 5)
    for ways in ("LLLL", "RRRR", "LRLR", "RLLR"):
        now = index.words()
        for k, way in enumerate(["", *ways], 1):
            if way:
                now = index.to_left(now) if way == "L" else index.to_right(now)
            got = {tuple(w): int(c) for w, c in zip(now.words.tolist(), now.count)}
            assert got == {p: c for p, c in want.items() if len(p) == k}
            assert len(got) == len(now.count)


def test_longer_phrases_pass_through_known_triples_only():
    seq = np.array([1, 2, 3, 1, 2, 3, 1, 0, 3, 1, 2, 4, 1, 2, 3], np.int64)
    index = word_index.WordIndex(seq, 5, 6)
    triples = index.to_right(index.to_left(index.words()))
    known = triples.where(triples.count > 1)
    allowed = {tuple(p) for p in known.words.tolist()}
    got = {tuple(w): int(c) for p in word_index.longer(index, known, 6) for w, c in zip(p.words.tolist(), p.count)}
    assert got == {p: c for p, c in _occurrences(seq.tolist(), 6).items() if len(p) > 3 and all(x in allowed for x in zip(p, p[1:], p[2:]))}
    assert got


# ------------------------------------------------------------ collocations
def plain_collocations(rows, least, most, top):
    low = {c: c + 32 for c in range(65, 91)}
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = {(lang, w[i : i + k]) for (lang, w), a in found.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if a >= f[lang, w[i : i + k]]}
    ranked = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in inside:
            s, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            ranked[lang].append((-s, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in ranked.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1))


def _phrase_rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["Ünï", "A", "\x00", "b c"]
    rows = []
    for _ in range(250):
        pool = words[: rnd.choice([3, 8, 34])]
        rows.append((rnd.choice(["en", "en", "de", None]), "".join(rnd.choice(pool) + rnd.choice([" ", " ", "  ", ". ", "\n", ", ", "\t"]) for _ in range(rnd.randrange(120)))))
    rows += [("en", None), ("en", ""), ("xx", " . "), (None, "Zz yy xx ww vv uu")] + [("en", "zz yy xx ww vv uu")] * 40
    return rows + [("en", "one long piece " * 700)]


@pytest.mark.parametrize("size,gathered", [(50, 900), (1 << 20, 1 << 23)])
@pytest.mark.parametrize("least,top", [(5, 40), (1, 100_000)])
def test_collocations_equal_plain_counts(spark, size, gathered, least, top):
    """With small shards texts and pieces are cut in many places; sums do not tell."""
    rows = _phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, least=least, top=top, size=size, gathered=gathered)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, 5, top)


def test_collocation_edges(spark, no_docs, wide_docs):
    assert collocations.collocations(no_docs).count() == 0
    rows = [(r["lang"], r["text"]) for r in wide_docs.collect()]
    clash = wide_docs.withColumn("phrase", F.lit(1)).withColumn("shard", F.lit("x")).withColumn("n", F.lit(None).cast("int"))
    assert sorted(map(tuple, collocations.collocations(clash, least=20, top=100).collect())) == plain_collocations(rows, 20, 5, 100)


@pytest.mark.parametrize("most", [2, 3, 4, 7])
def test_other_lengths(spark, most):
    rows = _phrase_rows()[:120]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=4, most=most, top=50, size=70, gathered=2000)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 4, most, 50)


def _one_shard(texts, number, parts, weight=1):
    """A shard of which every word is left, as the rounds after the words see it."""
    seq, words = collocations.word_ids("\n".join(texts).encode())
    names = [w.as_py().decode() for w in words]
    left = [(i << 32) + int(w[1:]) for i, w in enumerate(names)]
    row = {"shard": number, "lang": "en", "weight": weight, "parts": parts, "words": collocations.zstandard.compress("\n".join(names).encode()), "seq": collocations._packed(seq), "left": left}
    return next(collocations._frequent(row)).to_pylist()[0]


@pytest.mark.parametrize("step,length", [(collocations._send_pairs, 2), (collocations._send_triples, 3)])
def test_phrases_travel_packed_and_are_spelled_once(step, length):
    """Rows are one a shard and part, however many phrases; a phrase takes a few
    bytes; one of the shards that hold a frequent phrase gets its count."""
    rnd = random.Random(3)
    texts = [[" ".join(f"w{int(rnd.paretovariate(0.6)) % 5000}" for _ in range(4000)) for _ in range(8)] for _ in range(3)]
    rows = [_one_shard(t, i << 40, 7) for i, t in enumerate(texts)] + [_one_shard(texts[0][:1], 9, 7, -1)]
    truth = collections.Counter()
    for t, sign in [(x, 1) for t in texts for x in t] + [(texts[0][0], -1)]:
        w = t.split()
        truth.update({k: sign * c for k, c in collections.Counter(" ".join(w[i : i + length]) for i in range(len(w) - length + 1)).items()})
    sent = pa.Table.from_batches([b for r in rows for b in step(r)])
    assert sent.num_rows <= 7 * len(rows)
    phrases = sum(len(collocations._ints(x.as_py())) // (length + 1) for x in sent["phrases"])
    assert phrases > 10_000 and sum(len(x.as_py()) for x in sent["phrases"]) < 6 * phrases
    back = pa.concat_tables(collocations._summed(4)(sent.filter(pc.equal(sent["part"], p))) for p in range(7)).to_pylist()
    spelled = []
    for r in rows:
        r["back"] = [b for b in back if b["shard"] == r["shard"]]
        index, words, ids = collocations._opened(r, 3)
        p = index.to_left(index.words()) if length == 2 else collocations._triples(index)
        marks, f = collocations._marks(r, ids, p.words)
        named = collocations._texts(words, p.words).to_pylist()
        assert all((m > 0) == (truth[x] >= 4) for m, x in zip(marks, named))
        _, phrase, _, count = collocations._spelled(r, words, p.words, marks, f)
        spelled += zip(phrase.to_pylist(), count.to_pylist())
    assert sorted(spelled) == sorted((x, c) for x, c in truth.items() if c >= 4)


def test_phrase_sums_pass_32_bits():
    big = (1 << 31) - 1
    blob = collocations._packed(np.array([[5], [(1 << 31) - 2], [big]]).ravel())
    sent = pa.table({"lang": ["en"] * 3, "words": pa.array([2] * 3, pa.int32()), "part": pa.array([0] * 3, pa.int32()), "shard": [3, 1, 2], "phrases": pa.array([blob] * 3, pa.binary())})
    out = collocations._summed(3 * big)(sent).to_pylist()
    assert [r["shard"] for r in out] == [1, 2, 3]
    assert [np.frombuffer(collocations.zstandard.decompress(r["f"]), "<i8").tolist() for r in out] == [[3 * big], [], []]
    assert collocations._summed(3 * big + 1)(sent).num_rows == 0


def test_words_get_one_number_and_one_spelling(spark):
    rows = [("en", f"w{i}", 2, s << 40, i) for i in range(300) for s in range(3)] + [("de", "w1", 7, 5, 0), ("en", "rare", 5, 0, 300)]
    got = collocations._left_words(spark.createDataFrame(rows, "lang string, phrase string, n int, shard long, local int"), 6).collect()
    assert len(got) == 901 and sorted((r["lang"], r["phrase"], r["f"]) for r in got if r["phrase"]) == sorted([("de", "w1", 7), *(("en", f"w{i}", 6) for i in range(300))])
    numbers = collections.defaultdict(set)
    for r in got:
        numbers[r["shard"] == 5, r["local"]].add(r["id"])
    assert all(len(x) == 1 for x in numbers.values()) and len(set.union(*numbers.values())) == 301


def test_extensions_are_the_most_frequent_longer_phrases(spark):
    df = spark.createDataFrame([("en", "a b c")] * 5 + [("en", "x b c")] * 3 + [("en", "b d")] * 2, "lang string, text string")
    counts, totals = collocations.phrase_counts(df, least=2, most=3)
    got = {r["phrase"]: (r["f"], r["left"], r["right"]) for r in collocations.extensions(counts).collect()}
    assert got["b c"] == (8, 5, None) and got["b"] == (10, 5, 8) and got["a b"] == (5, None, 5)
    assert totals.collect()[0]["n"] == 28


def test_scores_are_exact_beyond_64_bits(spark):
    row = spark.range(1).select(collocations._score(*[F.lit(x).cast("long") for x in (10**13, 10**15 + 7, 10**13 + 1, 10**13)]).alias("s")).first()
    assert row["s"] == 1000 * 10**13 * (10**15 + 7) // ((10**13 + 1) * 10**13)


# -------------------------------------------------------------------- WARC
def plain_archive(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and (body not in first or i < first[body]):
            first[body] = i
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        lead = first.get(body)
        answer = lead is None or i == lead
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if answer else "revisit", None if answer else lead))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a.de/x y\r\nX-Evil: 1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "ends in line ends\r\n\r\n"),
    (6, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", "<p>one</p>"), (None, "v", "alone without id"), (7, "u", "Ünï 😀 \x00"), (7, "u", "Ünï 😀 \x00"),
    (8, "u", "long " * 300_000), (9, "u", "long " * 300_000), (2, "u", "another text of id 2"), (-5, "u", "<p>one</p>"),
]


def _through(spark, rows):
    folder = tempfile.mkdtemp(prefix="spanpack-warc-")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("value", F.lit(0)), f"{folder}/whole")
    index = warc.normalise(spark, f"{folder}/whole", f"{folder}/records")
    return index, warc.resolved(durable(warc.read_records(index)))


def test_archives_give_every_page_back(spark):
    index, found = _through(spark, PAGES)
    got = [(None if r["source_id"] is None else int(r["source_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], None if r["refers_source_id"] is None else int(r["refers_source_id"])) for r in found.collect()]
    assert sorted(got, key=str) == plain_archive(PAGES)
    assert found.where("stated_digest <> payload_digest").count() == 0
    assert _through(spark, [])[1].count() == 0


def test_every_record_is_a_member_and_the_sidecar_says_where(spark):
    index, _ = _through(spark, PAGES)
    rows = index.collect()
    assert len(rows) == len(PAGES)
    for name in {r["archive"] for r in rows}:
        mine = sorted((r for r in rows if r["archive"] == name), key=lambda r: r["offset"])
        data = open(name, "rb").read()
        assert [r["offset"] for r in mine] == [sum(x["length"] for x in mine[:i]) for i in range(len(mine))] and sum(r["length"] for r in mine) == len(data)
        for r in mine:
            raw = zlib.decompress(data[r["offset"] : r["offset"] + r["length"]], 31)
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == len(mine)
        assert len(open(name + ".idx").read().splitlines()) == len(mine)


def _record(body: bytes, kind=b"resource") -> bytes:
    return b"WARC/1.0\r\nwarc-type: " + kind + b"\r\nContent-Type: image/x\r\nCONTENT-LENGTH: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


@pytest.mark.parametrize("pack", ["one stream", "members", "cut anywhere"])
def test_foreign_archives(spark, pack):
    """Binary payloads, records in one stream, a member each, or members that end within records."""
    rnd = random.Random(3)
    bodies = [b"", b"\r\n\r\n", bytes(range(256)) * 9000, b"WARC/1.0\r\n\r\n", rnd.randbytes(3_000_000)]
    raw = b"".join(map(_record, bodies))
    if pack == "one stream":
        data = gzip.compress(raw)
    elif pack == "members":
        data = b"".join(gzip.compress(_record(b)) for b in bodies)
    else:
        data = gzip.compress(raw[:777]) + gzip.compress(raw[777:900_001]) + gzip.compress(raw[900_001:]) + b"\0" * 20
    folder = tempfile.mkdtemp(prefix="spanpack-warc-")
    os.mkdir(f"{folder}/in")
    open(f"{folder}/in/a.warc.gz", "wb").write(data)
    got = warc.read_records(warc.normalise(spark, f"{folder}/in", f"{folder}/out"), with_payload=True).collect()
    assert [bytes(r["payload"]) for r in sorted(got, key=lambda r: r["offset"])] == bodies


@pytest.mark.parametrize("harm", [lambda d: d[:-30], lambda d: gzip.compress(gzip.decompress(d)[:-2000]), lambda d: gzip.compress(b"no archive\r\n\r\n")])
def test_a_broken_archive_is_an_error(harm):
    data = harm(gzip.compress(_record(b"x" * 3000)))
    import io

    with pytest.raises(ValueError):
        list(warc.rewrite(warc.inflated(io.BytesIO(data).read), lambda b: None))


# ------------------------------------------------------------ vector codes
def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i, [int(np.floor(256 * x)) for x in v], lab) for i, v, lab in rows if v and all(x is not None and np.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for _, v, _ in kept:
                groups[near(v, p)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if groups[i] else e for i, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)), sum(near(v, p)[0] for p in range(parts)), lab) for i, v, lab in kept]
    total = collections.Counter()
    for _, _, e, lab in coded:
        total[lab] += e
    return sorted(((i, c, e, total[lab], sha) for i, c, e, lab in coded), key=str)


def _vectors(n, dims, seed=1):
    rnd = np.random.default_rng(seed)
    v = np.round(rnd.normal(0, 0.2, (n, dims)), 2)
    v[n // 2 : n // 2 + n // 3] = v[0]                     # a third of all rows alike
    return [(int(i), [float(np.float32(x)) for x in row], None if i % 5 == 0 else int(i % 3)) for i, row in enumerate(v)]


BAD = [(900, None, 1), (901, [0.5] * 31 + [None], 1), (902, [0.5] * 31 + [float("nan")], 1), (903, [float("-inf")] * 32, 2), (904, [], 1)]


@pytest.mark.parametrize("rows", [_vectors(300, 32) + BAD, _vectors(20, 16), _vectors(90, 48) + [(None, [0.25] * 48, 7)] * 3, BAD, []])
def test_vector_codes_equal_plain_ones(spark, rows):
    folder = tempfile.mkdtemp(prefix="spanpack-vec-")
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("mine")).withColumn("v", F.lit(1))
    table.repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    got = sorted(map(tuple, queries.op13_vector_codes(spark, folder).collect()), key=str)
    assert got == plain_codes(rows)


def test_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.op13_vector_codes(spark, SF0001).collect()), key=str) == plain_codes(rows)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.integers(0, 10**6))
def test_masks_hold_every_nearest_entry(k, width, seed):
    rnd = np.random.default_rng(seed)
    book, x = rnd.integers(-9, 9, (k, width)), rnd.integers(-12, 12, (40, width))
    d = ((x[:, None] - book[None]) ** 2).sum(2)
    s = vector_codes.Slices(book)
    found, least = s.nearest(x)
    assert (found == d.argmin(1)).all() and (least == d.min(1)).all()
    masks = s.candidates(x)
    for i, e in np.argwhere(d == d.min(1)[:, None]):
        assert int(masks[i]) >> int(e) & 1


def test_codes_decode_to_their_entries(spark):
    rows = _vectors(80, 32)
    kept, n = vector_codes.kept_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), 16)
    books = vector_codes.learn(kept, n)
    out = vector_codes.decode(vector_codes.encode(kept, books), books).join(kept.select("vec_id", "v"), "vec_id")
    for r in out.collect():
        assert sum((a - int(np.floor(256 * b))) ** 2 for a, b in zip(r["decoded"], r["v"])) == r["error"]


def test_too_large_a_component_says_so(spark):
    table = spark.createDataFrame([(1, [1e30] * 16, 1)], "vec_id long, embedding array<float>, label int")
    kept, n = vector_codes.kept_vectors(table, 16)
    with pytest.raises(ValueError, match="64 bits"):
        vector_codes.learn(kept, n)
