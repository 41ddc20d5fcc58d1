"""Small tests that whole jobs are done: rare labels, repeated passages, identifiers at ends of sentences."""

from __future__ import annotations

import random

import pytest

from facturo.llm import common, langid, near_dedup, pii


@pytest.fixture(scope="module")
def session(spark):
    return common.prepare(spark)


def test_rare_label_has_a_model(session):
    r = random.Random(5)
    letters = {"aa": "abcdefgh", "zz": "αβγδεζηθ"}
    text = lambda k: " ".join("".join(r.choices(letters[k], k=6)) for _ in range(30))
    # ordered by label: the rare one comes last, 8 rows of 20,008; repeated rows and rows without letters make no model
    rows = [(i, text("aa"), "aa", None) for i in range(20000)] + [(20000 + i, text("zz"), "zz", None) for i in range(8)]
    rows += [(30000 + i, "12 34", "nn", None) for i in range(9)] + [(40000 + i, text("aa"), "few", None) for i in range(4)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(langid.labelled_documents(docs), sample_rows=100)
    assert model.languages == ["aa", "zz"]
    kept = langid.drop_unidentified(docs.where("lang = 'zz'"), model)
    assert kept.count() == 8
    assert langid.fit(langid.labelled_documents(docs.limit(0))).languages == []


def test_near_copies_with_a_repeated_passage(session):
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**9)}"
    texts = []
    for _ in range(100):
        common_words, footer = [word() for _ in range(104)], [word() for _ in range(21)]
        # plain similarity 0.8 or a little more: one text repeats its own footer 1000 times
        texts += [" ".join(common_words), " ".join(common_words + footer[:3] + footer[3:] * 1000)]
    digests, bands, sizes, bits = near_dedup.sketch(texts)
    assert all(len(set(x)) == len(x) for x in bands)
    similar = shared = allowed = 0
    for i in range(0, len(texts), 2):
        a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts[i : i + 2]))
        similar += len(a & b) / len(a | b) >= 0.8
        shared += bool(set(bands[i]) & set(bands[i + 1]))
        allowed += sum(int(x).bit_count() for x in (bits[i] ^ bits[i + 1]).view("uint64")) <= 48
    assert similar == shared == allowed == 100
    found = near_dedup.mark_near_copies(session.createDataFrame(list(enumerate(texts[:20])), "doc_id long, text string")).collect()
    assert all(x["class_id"] == x["doc_id"] // 2 * 2 and x["class_size"] == 2 for x in found)


def test_identifiers_before_punctuation_and_far_context(session):
    far, word = " " * 200, "long" * 50
    # eight known mails stand in each context, and so does an identifier followed by a sign
    texts = [f"my id is user{i}@mail.example . Then" for i in range(8)] + ["my id is AB-1234567. Then", "my id is AB-7654321: x", "my id is ._AB-1111111... Then", f"{'q-' * 70}AB12345 here"]
    texts += [f"{word}{far}user{i}@far.example{far}{word}" for i in range(8)] + [f"{word}{far}CD-1234567{far}{word}"]
    texts += ["- " * 50 + "-" * 50000 + "a-" * 50000 + "1"]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, spans = pii.found_spans(docs)
    found = {(r["match"], r["start"]): r for r in rows.join(spans, "at").where("kind = 'id' and length(match) < 200 and match not like '%@%'").collect()}
    assert set(found) == {("AB-1234567", 9), ("AB-7654321", 9), ("._AB-1111111", 9), ("q-" * 70 + "AB12345", 0), ("CD-1234567", 400)}
    assert (found["AB-1234567", 9]["tail"], found["AB-1234567", 9]["head"]) == ("is", ".")
    assert (found["CD-1234567", 400]["tail"], found["CD-1234567", 400]["head"]) == (word, word)
    assert pii.candidates(spans).where("match = 'AB-1234567'").count() == 1


def test_one_sided_contexts_and_late_instances(session):
    texts = [f"please write to user{i}@mail.example" for i in range(9)] + ["please write to QX77-81923-ZZ", "never seen QX88-81923-ZZ"]
    # identifiers of level k stand in the contexts of levels k and k + 1, so level 4 is reached in round 4
    sizes = [400, 100, 30, 12, 1]
    for k, n in enumerate(sizes):
        held = [f"user{i}@far.example" if k == 0 else f"K{k}-{i:05}-QQ" for i in range(n)]
        texts += [f"x{c} {m} y{c}" for m in held for c in (k, k + 1)]
    found = pii.personal_data(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    ids = {s["match"] for r in found for s in r["spans"] if s["kind"] == "id"}
    assert "QX77-81923-ZZ" in ids
    assert "QX88-81923-ZZ" not in ids
    assert {x for x in ids if x.startswith("K")} == {f"K{k}-{i:05}-QQ" for k, n in enumerate(sizes) if k for i in range(n)}


def test_licence_in_a_sentence_and_hostile_rows(session):
    from facturo.llm import licences

    bsd = next(t for n, t in licences.TEMPLATES if n == "BSD-3-Clause" and "DAMAGE" in t)
    wrapped = bsd.replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n2. ").replace(" THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS")
    rows = [
        (1, "Made with care. Released under the MIT Licence. Thanks to all!"),
        (2, "Made with care, not released. Thanks to all!  MIT is a school. "),
        (3, wrapped),
        (4, "one word. " * 100_000 + "Licensed under CC BY 4.0! Bye"),
        (5, None),
        (6, ""),
        (1, "Made with care. Released under the MIT Licence. Thanks to all!"),
        (None, "Hello. This work is licensed under the GNU General Public License, version 2. Good-bye."),
    ]
    docs = session.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, scope string, unit int")
    found = sorted(map(tuple, licences.scan_licences(docs).collect()), key=str)
    assert found == sorted(
        [
            (1, "sentence", 1, "MIT", 1.0),
            (1, "sentence", 1, "MIT", 1.0),
            (3, "text", 0, "BSD-3-Clause", 1.0),
            (3, "line", 0, "BSD-3-Clause", 1.0),
            (4, "sentence", 100_000, "CC-BY-4.0", 1.0),
            (None, "line", 0, "GPL-2.0", 0.88),  # the line has 14 bigrams, the notice 11 of them
            (None, "sentence", 1, "GPL-2.0", 1.0),
        ],
        key=str,
    )
    assert licences.scan_licences(docs.limit(0)).collect() == []
