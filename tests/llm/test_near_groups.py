"""A large group of near copies is looked at once a text, not once a band that its texts share."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

import corpus_pipeline
from facturo.llm import common, near_dedup


@pytest.fixture(scope="module")
def session(spark):
    return common.prepare(spark)


def _changed(r, words, n):
    out = list(words)
    for k in r.sample(range(len(out)), n):
        out[k] = f"x{r.randrange(10**9)}"
    return out


def _counted(monkeypatch):
    """Rows of the tables that near_dedup writes, by their names."""
    written = defaultdict(list)

    def counted(df, spark, name):
        out = common.materialize(df, spark, name)
        written[name].append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialize", counted)
    return written


def _shares(texts):
    """How often a text shares a band with its least text, and how many pairs of texts do."""
    nodes = {t: i for i, t in reversed([*enumerate(texts)]) if t}
    buckets = defaultdict(list)
    for i, bands in zip(nodes.values(), near_dedup.sketch(list(nodes))[1], strict=True):
        for band in bands:
            buckets[int(band)].append(i)
    return sum(len(b) - 1 for b in buckets.values()), len({(min(b), i) for b in buckets.values() for i in b if i != min(b)})


def test_group_of_near_copies(session, monkeypatch):
    r = random.Random(3)
    base = [f"w{r.randrange(10**9)}" for _ in range(200)]
    # near the limit: 2 to 8 changed words leave similarities of 0.5 to 0.9, so the group has links, strays and chains
    texts = [" ".join(_changed(r, base, r.randrange(2, 9))) for _ in range(150)]
    texts += [" ".join(_changed(r, t.split(), 2)) for t in texts[:40]] + [texts[0], " ".join(texts[1].split()), None, ""]

    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in ((t or "").split() for t in texts)]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and len(a & b) >= 0.8 * len(a | b) and label[i] != label[j]:
                least, most = sorted((label[i], label[j]))
                label = [least if x == most else x for x in label]
    assert 2 < len(set(label)) < len(texts) - 2

    written = _counted(monkeypatch)
    found = near_dedup.mark_near_copies(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x["doc_id"]: (x["class_id"], x["class_size"], x["kept"]) for x in found} == {i: (x, label.count(x), x == i) for i, x in enumerate(label)}

    shares, pairs = _shares(texts)
    assert shares > 1.5 * pairs
    assert written["labelled-members"] and max(written["labelled-members"]) <= pairs


def test_pipeline_stage_on_a_group_of_near_copies(session, monkeypatch):
    r = random.Random(4)
    base = [f"w{r.randrange(10**9)}" for _ in range(200)]
    texts = [" ".join(_changed(r, base, r.randrange(1, 3))) for _ in range(40)] + ["a text alone", None]
    written = _counted(monkeypatch)
    docs = session.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    # one or two changed words: every text is similar to one of the others, all through the first
    assert sorted(map(tuple, corpus_pipeline.drop_near_copies(session, docs, "").collect()), key=lambda x: x[0]) == [(0, texts[0], "en"), (40, "a text alone", "en"), (41, None, "en")]
    shares, pairs = _shares(texts)
    assert shares > 1.5 * pairs
    assert written["labelled-members"] and max(written["labelled-members"]) <= pairs
