"""Vector codes, filter audit and byte-level BPE against brute force, and with hostile rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from array import array
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from facturo.llm import byte_bpe, common, filter_audit, vector_codes
from facturo.llm.queries import read_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    return common.prepare(spark)


def oracle(sql, *tables):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con.execute(sql).df()


def same(found, expected):
    found, expected = found.toPandas(), expected[found.columns]
    keys = list(found.columns)
    assert found.astype(str).sort_values(keys).values.tolist() == expected.astype(str).sort_values(keys).values.tolist()


# --- vector codes


def coded_by_hand(rows, parts, entries, rounds, scale):
    """{row index: (code, error)} and the codebooks, in plain Python with exact numbers."""
    kept = [(i, v) for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda x: (rows[x[0]][0] is None, rows[x[0]][0] or 0, [math.floor(Fraction(c) * scale) for c in x[1]]))
    kept = [(i, v) for i, v in kept if len(v) == len(first[0][1])]
    width = -(-len(first[0][1]) // parts)
    cut = {i: [([math.floor(Fraction(x) * scale) for x in v] + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for i, v in kept}
    books = [[cut[i][p] for i, _ in first if i in cut][:entries] for p in range(parts)]
    near = lambda book, x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        found = {i: [near(books[p], cut[i][p])[1] for p in range(parts)] for i in cut}
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut[i][p] for i in cut if found[i][p] == k]
                if own:
                    books[p][k] = [math.floor(Fraction(sum(c), len(own))) for c in zip(*own)]
    last = {i: [near(books[p], cut[i][p]) for p in range(parts)] for i in cut}
    return {i: (bytes(k for _, k in x), min(sum(d for d, _ in x), 2**63 - 1)) for i, x in last.items()}, books


def test_orchard_search_is_exact_with_ties():
    r = np.random.default_rng(7)
    for k, spread in ((1, 5), (2, 3), (40, 3), (256, 300)):
        entries, queries = r.integers(-spread, spread, (k, 4)), r.integers(-spread, spread, (500, 4))
        full = ((queries[:, None] - entries) ** 2).sum(axis=2)
        for kind in (np.int64, object):
            index, distance = vector_codes.Lists(entries.astype(kind)).nearest(queries.astype(kind))
            assert index.tolist() == full.argmin(axis=1).tolist() and distance.tolist() == full.min(axis=1).tolist()


@pytest.mark.parametrize("dimension", [8, 6])
def test_vector_codes_by_hand(session, dimension):
    r = random.Random(dimension)
    rows = [(i, [r.uniform(-2, 2) for _ in range(dimension)]) for i in range(60)]
    rows += [(3, [0.5] * dimension)] * 20 + [(None, [0.25] * dimension), (70, None), (71, [0.1] * (dimension - 1) + [None]), (72, [float("nan")] * dimension), (73, [float("inf")] * dimension), (74, [0.1]), (75, [])]
    rows += [(80, [1e30] * dimension), (81, [-1e300] + [0.0] * (dimension - 1))]
    df = session.createDataFrame([(i, v, "x" if k % 3 else None, "clash", b"") for k, (i, v) in enumerate(rows)], "vec_id long, embedding array<double>, label string, row string, code binary")
    expected, books = coded_by_hand(rows, 4, 16, 3, 1024)
    found, width = vector_codes.codebooks(df, entries=16, rounds=3)
    assert width == dimension and [[list(e) for e in b] for b in found] == books
    codes = vector_codes.compressed(df, found, width)
    assert sorted((bytes(x["code"]), x["error"]) for x in codes.collect()) == sorted(expected.values())
    near = vector_codes.decoded(codes.where("row.vec_id = 3"), found, width).first()
    assert near["approximation"] == [v / 1024 for p, e in enumerate(near["code"]) for v in found[p][e]][:width]
    whole = vector_codes.vector_codes(df).collect()
    assert len(whole) == len(expected) and len({x["label_error"] for x in whole}) <= 2


def test_vector_codes_empty_and_without_vectors(session):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.vector_codes(session.createDataFrame([], schema)).collect() == []
    assert vector_codes.vector_codes(session.createDataFrame([(1, None, 1), (2, [None], 1)], schema)).collect() == []
    one = vector_codes.vector_codes(session.createDataFrame([(1, [], None)] * 2, schema)).collect()
    assert [(x["code"], x["error"], x["label_error"]) for x in one] == [("00000000", 0, 0)] * 2


def test_vector_codes_oracle(session):
    same(vector_codes.vector_codes(read_table(session, SMALL, "embeddings")), oracle(vector_codes.oracle_sql(), "embeddings"))


# --- filter audit


def audited_by_hand(docs, labels):
    """All rows of the audit, every order walked document by document."""
    letters = "ABCDE"
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    fails = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = {c for c, x in zip(letters, [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), doc_id is not None and least[text] < doc_id], strict=True) if x}
        says = [x for x in labels if doc_id is not None and x[0] == doc_id]
        fails.append((source or "", own, any(x[1] == 1 for x in says), any(x[2] == 1 for x in says)))
    out = []
    for part in {f[0] for f in fails}:
        rows, shapley = [f for f in fails if f[0] == part], dict.fromkeys(letters, 0)
        mine = []
        for order in itertools.permutations(letters):
            for step, c in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [f for f in rows if c in f[1] and not f[1] & before]
                shapley[c] += len(gone)
                mine.append([part, "".join(order), step, sum(not f[1] & set(order[:step]) for f in rows), len(gone), sum(c in f[1] and bool(f[1] & before) for f in rows), sum(f[1] == {c} for f in rows), sum(f[2] for f in gone), sum(f[3] for f in gone), c])
        out += [(*m[:-1], shapley[m[-1]]) for m in mine]
    return sorted(out)


def test_filter_audit_by_hand(session):
    r = random.Random(4)
    plain = [" ".join(r.choices([f"w{i}" for i in range(200)], k=n)) for n in (60, 80, 55)]
    texts = [*plain, *plain, None, "", "  \t", "short # one", " ".join(["same"] * 70), "LOUD " * 60, "Ünïcode\x1cword " * 51, "é" * 10000, plain[0].upper() + " $", " ".join(plain)]
    docs = [(i if i % 5 else None, t, r.choice(["a", "b", "", None])) for i, t in enumerate(texts * 3)]
    docs += [docs[1]] * 30 + [(7, "x" * 2_000_00, "a")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(20)] + [(1, 1, 0), (None, 1, 1), (999, 1, 1)]
    frame = session.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, source string, part string, mask int")
    marks = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.filter_audit(frame, marks)
    assert sorted(map(tuple, found.collect())) == audited_by_hand(docs, labels)


def test_filter_audit_paths_and_empty(session):
    forward, backward = filter_audit.path_counts(5)
    for s in range(32):
        n = s.bit_count()
        assert forward[s] == math.factorial(n) and backward[s] == math.factorial(5 - n)
    empty = session.createDataFrame([], "doc_id long, text string, source string")
    labels = session.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(empty, labels).collect() == []
    one = filter_audit.filter_audit(session.createDataFrame([(None, None, None)], empty.schema), labels).collect()
    assert len(one) == 600 and {(x["part"], x["kept"]) for x in one if x["step"] == 5} == {("", 0)}


def test_filter_audit_oracle(session):
    found = filter_audit.filter_audit(read_table(session, SMALL, "documents"), read_table(session, SMALL, "labels"))
    same(found, oracle(filter_audit.oracle_sql(), "documents", "labels"))


# --- byte-level BPE


def encoded_by_hand(text):
    ids = byte_bpe._encoding(byte_bpe.default_ranks(), byte_bpe.default_pattern()).encode_ordinary(text or "")
    return array("I", ids).tobytes()


@pytest.mark.parametrize("chunk, overlap", [(50, 10), (64, 5), (300, 40)])
def test_chunks_meet_anywhere(session, chunk, overlap):
    r = random.Random(chunk)
    signs = "ab '\"s\n\t  1.xü中文，😀re \x1c"
    texts = [None, "", "a", "x" * 3000, " " * 2000 + "a", "\n " * 900, "中" * 2000, "don't we'll'd " * 200, "ab" * 400 + " " + "c" * 500 + " d" * 300, "<|endoftext|> " * 30]
    texts += ["".join(r.choices(signs, k=r.randrange(2000))) for _ in range(50)] + ["dup " * 100] * 3
    rows = [(i if i % 7 else None, t, "clash", 0, "row") for i, t in enumerate(texts)]
    docs = session.createDataFrame(rows, "doc_id long, text string, ids string, start int, row string")
    both = byte_bpe.decode(byte_bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    key = lambda x: (str(x[0]), x[1], x[2])
    found = sorted(((x["row"]["doc_id"], bytes(x["ids"]), bytes(x["bytes"])) for x in both), key=key)
    assert found == sorted(((i, encoded_by_hand(t), (t or "").encode()) for i, t, *_ in rows), key=key)
    assert all(x["row"]["row"] == "row" for x in both)


def test_token_digests_of_whole_texts(session):
    docs = read_table(session, SMALL, "documents").select("doc_id", "text")
    docs = docs.unionAll(session.createDataFrame([(10**9, "word, other; " * 200_000), (None, None)], docs.schema))
    found = sorted(map(tuple, byte_bpe.token_digests(docs).collect()), key=str)
    expected = [(i, encoded_by_hand(t), (t or "").encode()) for i, t in docs.collect()]
    assert found == sorted(((i, len(a) // 4, hashlib.sha256(a).hexdigest(), hashlib.sha256(b).hexdigest()) for i, a, b in expected), key=str)
    assert byte_bpe.token_digests(docs.limit(0)).collect() == []
