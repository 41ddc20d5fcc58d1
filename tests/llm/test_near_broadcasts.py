"""What near-dedup sends through the driver does not grow with the number of near copies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from facturo.llm import common, near_dedup


@pytest.fixture(scope="module")
def session(spark):
    return common.prepare(spark)


PAIRS = 3000


@pytest.fixture(scope="module")
def texts():
    """PAIRS texts, and one near copy of each that shares some 26 of its 32 bands."""
    r = random.Random(5)
    firsts = [" ".join(f"w{r.randrange(10**9)}" for _ in range(60)) for _ in range(PAIRS)]
    out = firsts + [t.rsplit(" ", 1)[0] + f" x{i}" for i, t in enumerate(firsts)]
    bands = near_dedup.sketch(out[:20] + out[PAIRS : PAIRS + 20])[1]
    assert sum(len({*bands[i]} & {*bands[20 + i]}) for i in range(20)) * PAIRS / 20 > 60_000
    return out


@pytest.fixture
def sent(monkeypatch):
    """Rows of each table that is broadcast."""
    rows, broadcast = [], F.broadcast

    def counted(df):
        rows.append(df.count())
        return broadcast(df)

    monkeypatch.setattr(F, "broadcast", counted)
    return rows


def test_no_broadcast_grows_with_the_shared_bands(session, texts, sent):
    found = near_dedup.mark_near_copies(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x["doc_id"]: (x["class_id"], x["class_size"], x["kept"]) for x in found} == {i: (i % PAIRS, 2, i < PAIRS) for i in range(2 * PAIRS)}
    assert sent and max(sent) <= 50_000


def test_no_broadcast_of_the_pipeline_stage_grows(session, texts, sent):
    docs = session.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, corpus_pipeline.drop_near_copies(session, docs, "").collect())) == [(i, t, "en") for i, t in enumerate(texts[:PAIRS])]
    assert sent and max(sent) <= 50_000


@pytest.mark.parametrize("blocks", [None, 0])
def test_rows_of_named_nodes(session, monkeypatch, blocks):
    r = random.Random(6)
    at = sorted({(part << 33) + r.randrange(9000) for part in (0, 1, 2, (1 << 29) + 3) for _ in range(1500)})
    nodes = r.sample(at, 700) + [63, 64, 4095, 4096, (5 << 33) + 1]
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    if blocks is not None:
        monkeypatch.setattr(near_dedup, "BLOCKS", blocks)
    rows = session.createDataFrame([(f"t{x}", x) for x in [*at, at[0], None]], "text string, at long")
    named = session.createDataFrame([(x,) for x in nodes * 2], "node long")
    found = near_dedup._named(rows, "at", named, len(nodes))
    assert found.columns == ["text", "at"]
    assert sorted(x["at"] for x in found.collect()) == sorted(x for x in [*at, at[0]] if x in set(nodes))
    assert not near_dedup._named(rows, "at", named.where("false"), 1).count()
