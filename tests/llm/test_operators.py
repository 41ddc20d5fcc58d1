"""Small tests of the training-data operators against brute force, and of hostile rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from facturo.llm import common, decontaminate, exact_dedup, graph, langid, licences, near_dedup, packing, pii, token_store, tokens, url_filter, warc
from facturo.llm.shingles import shingles, word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string"
WORDS = [f"w{a}{b}" for a in "abcdefghijklmnop" for b in "qrstuvwxyz"]


@pytest.fixture(scope="module")
def session(spark):
    return common.prepare(spark)


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, nulls, blanks, one very long text, ties and repeated rows, with clashing extra columns."""
    r = random.Random(3)
    base = [" ".join(r.choices(WORDS, k=60)) for _ in range(12)]
    texts = [*base, base[0], base[0].replace(" ", "  \n"), None, "", "   ", "one", "one two three", "12 34", "x" * 3000, " ".join(r.choices(WORDS, k=30000))]
    for b in base[:4]:
        words = b.split()
        words[30] = "changed"
        texts.append(" ".join(words))
        words[0], words[59] = "other", "ends"
        texts.append(" ".join(words))
    out = [(i, t, "en" if i % 3 else "fr", "src0", len(t or ""), False, "x") for i, t in enumerate(texts)]
    return [*out, out[0], out[0], (None, base[5], None, None, None, None, None), (None, None, None, None, None, None, None)]


def sets_of(texts):
    words, counts = word_hashes(texts)
    h, owner = shingles(words, counts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [set(h[a:b].tolist()) for a, b in zip(cuts, cuts[1:], strict=False)]


def test_word_ids_equal_the_library():
    encoder = tokens.word_ids(tokens.default_tokenizer())
    r = random.Random(1)
    letters = "abcXYZ'’stdmlrev 09 .,!<|endoftext|>ÀéßÿΣσς 　\x1c\x85\n\tİıﬁ漢字١½µ×÷"
    for text in ["<|endoftext|>x it's we'll 'stuff don't a.,b", *("".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(800))]:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 0), (5, 0), (1000, 10), (70000, 10**9), (300, 2**62)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(1).integers(0, top + 1, n, dtype=np.uint64))
    data = token_store.EliasFano.of(values).to_bytes()
    read, end = token_store.EliasFano.from_buffer(memoryview(data))
    assert end == len(data) and (read.decode() == values).all()
    assert all(read.select(i) == int(values[i]) for i in range(0, n, max(1, n // 50)))


def test_token_files(session, rows):
    path = tokens.default_tokenizer()
    docs = session.createDataFrame(rows, DOCS)
    found = token_store.token_index(session, docs, path).collect()
    tokenizer = tokens.word_ids(path).tokenizer
    want, at = [], 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):  # equal and null doc_ids keep the order of the input
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    assert token_store.token_index(session, docs.limit(0), path).count() == 0


def test_exact_dedup(session, rows):
    for words in (exact_dedup.MAX_WORDS, 1):  # one word: nearly every row is a possible repeat
        found = exact_dedup.mark_copies(session.createDataFrame(rows, DOCS), max_words=words).collect()
        norm = [re.sub("[\x20\x09-\x0d]+", " ", r[1] or "") for r in rows]
        size = Counter(norm)
        least = {t: min((r[0] for r, n in zip(rows, norm, strict=True) if n == t and r[0] is not None), default=None) for t in size}
        want = Counter((r[0], least[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for r, t in zip(rows, norm, strict=True))
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == want
        kept = [r for r in found if r["kept"]]
        assert len(kept) == len(size) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_components_and_merging(session):
    rng = random.Random(5)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)] + [(100, i) for i in range(80, 100)]
    more = [(rng.randrange(70), rng.randrange(70)) for _ in range(12)] + [(200, 201), (201, 200), (90, 91)]

    def brute(edges):
        label = {n: n for e in edges if e[0] != e[1] for n in e}
        changed = True
        while changed:
            changed = False
            for a, b in edges:
                if a != b and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
        return label

    def table(edges):
        return session.createDataFrame(edges, "a long, b long")

    components = graph.connected_components(table(first))
    assert {r.node: r.component for r in components.collect()} == brute(first)
    merged = graph.merged_components(components, table(more))
    assert {r.node: r.component for r in merged.collect()} == brute(first + more)
    assert graph.connected_components(table([])).count() == 0
    assert graph.merged_components(components, table([(100, 99)])).count() == components.count()


def test_near_dedup(session, rows):
    found = near_dedup.mark_near_copies(session.createDataFrame(rows, DOCS)).collect()
    sets = sets_of([r[1] for r in rows])
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) / len(a | b) >= 0.8:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, r in enumerate(rows):
        classes[root(i)].append(r[0])
    want = Counter((r[0], min((x for x in classes[root(i)] if x is not None), default=None), len(classes[root(i)])) for i, r in enumerate(rows))
    assert Counter((r["row"]["doc_id"], r["class_id"], r["class_size"]) for r in found) == want
    assert sum(r["kept"] for r in found) == len(classes)


def test_decontamination_catches_reordered_passages(session):
    r = random.Random(9)
    item = r.choices(WORDS, k=40)
    other = " ".join(r.choices(WORDS, k=50))
    halves = " ".join([*item[20:], other, *item[:20]])
    docs = session.createDataFrame([(1, f"{other} {' '.join(item)}"), (2, halves), (3, other), (4, None), (5, " ".join(item[:12])), (2, halves)], "doc_id long, text string")
    bench = session.createDataFrame([(7, " ".join(item)), (8, None), (9, "too short"), (7, " ".join(item))], "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]): x for x in decontaminate.contaminated(docs, bench).collect()}
    assert set(found) == {(1, 7), (2, 7)} and found[2, 7]["covered"] == 40 and len(found[2, 7]["tiles"]) == 2
    assert sorted(x["doc_id"] for x in decontaminate.drop_contaminated(docs, bench).collect()) == [3, 4, 5]
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 6


def test_reduction_keeps_the_optimum():
    def best(items, capacity):
        least = [len(items)]

        def place(i, bins):
            if len(bins) >= least[0]:
                return
            if i == len(items):
                least[0] = len(bins)
                return
            for room in {b for b in bins if b + items[i] <= capacity}:
                j = bins.index(room)
                place(i + 1, [*bins[:j], room + items[i], *bins[j + 1 :]])
            place(i + 1, [*bins, items[i]])

        place(0, [])
        return least[0]

    r = random.Random(5)
    for t in range(600):
        capacity = r.choice([7, 10, 20, 50])
        items = sorted((r.randint(1 if t % 2 else capacity // 4, capacity) for _ in range(r.randint(1, 8))), reverse=True)
        closed, rest = packing.reduce_dominated(Counter(items), capacity)
        left = sorted((s for s, n in rest.items() for _ in range(n)), reverse=True)
        assert all(sum(s * q for s, q in held) <= capacity for _, held in closed)
        assert best(items, capacity) == sum(n for n, _ in closed) + best(left, capacity)


def best_fit(lengths, capacity):
    """Number of bins by plain best fit decreasing, piece by piece."""
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        j = min((j for j, room in enumerate(bins) if room >= n), key=lambda j: bins[j], default=None)
        if j is None:
            bins.append(capacity - n)
        else:
            bins[j] -= n
    return len(bins)


def test_packing(session, rows):
    found = packing.pack(session.createDataFrame(rows, DOCS), tokens.default_tokenizer(), capacity=256, with_ids=True)
    held = defaultdict(list)
    for r in found.collect():
        assert r["length"] == len(r["ids"]) // 4 <= 256 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in held.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 256
    assert len(held) <= best_fit([n for s in held.values() for _, n in s], 256)


def test_packing_of_equal_rows_and_empty_table(session):
    """A third of all rows are one row: they are dealt over buckets and packed like others."""
    rows = [(7, "same words here")] * 500 + [(None, None)] * 100 + [(i, f"other {i} " * (1 + i % 9)) for i in range(900)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = packing.pack(docs, tokens.default_tokenizer(), capacity=64).collect()
    assert Counter(r["doc_id"] for r in found if r["piece"] == 0) == Counter(r[0] for r in rows)
    held = defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in held.values():
        s.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and s[0][0] == 0 and sum(s[-1]) <= 64
    assert len(held) <= best_fit([r["length"] for r in found], 64)
    assert packing.pack(docs.limit(0), tokens.default_tokenizer()).count() == 0


def test_warc(session):
    big = "é" * 600
    rows = [(1, "http://a/1", big), (9, "http://a/2 x\n", big), (9, None, big), (3, "u", "small"), (4, "u", "small"), (5, None, None), (None, "n", big)]
    found = warc.archive_round_trip(session, session.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = html == big and page != 9
        want[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found) == want


def test_url_aliases(session):
    link = '<LINK href="{}" rel="canonical">'.format
    rows = [(1, "http://a.net/1", link("http://b.net/2")), (2, "http://B.net/2#x", "<meta http-equiv=refresh content='0; url=/3'>"), (3, "http://b.net/3", None), (4, "http://z.com/de/x", link("http://a.net/1")), (5, "http://q.net/1", link("http://w.com/fr/9")), (6, None, None), (7, "no url", "")]
    rules = session.createDataFrame([("block", "com", "/de/"), ("allow", "com", "/fr/"), ("block", "net", "/zzz")], url_filter.RULES)
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(session.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    assert found == {1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: ("com/de/", "block"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow")}


def test_links_are_resolved_like_urljoin(session):
    from urllib.parse import urldefrag, urljoin, urlsplit, urlunsplit

    from pyspark.sql import functions as F

    bases = ["http://a.net/x/y/z?q=1#f", "https://B.org", "http://c.com/", "http://d.com/p/"]
    targets = ["../x", "./x", "?q=2", "/r/./s/../t", "//h.org/u/../v", "http://e.org/a/../b?c=../d", "x/..", "..", "../../../w/", ".", "y.html#top", "../?k=/../", "#only"]
    pairs = [(i, b, t) for i, (b, t) in enumerate((b, t) for b in bases for t in targets)]
    found = session.createDataFrame(pairs, "i int, url string, target string").select("i", url_filter.absolute_url(F.col("target"), F.col("url")).alias("to")).collect()

    def joined(base, target):
        # urljoin leaves the dot segments of targets with a host
        whole = urldefrag(urljoin(base, target))[0]
        parts = urlsplit(whole)
        return urljoin(whole, urlunsplit(("", "", parts.path or "/", parts.query, "")))

    same = lambda u: urldefrag(u)[0] + ("/" if urldefrag(u)[0].count("/") == 2 else "")
    assert [(b, t, same(r["to"])) for r, (_, b, t) in zip(sorted(found), pairs, strict=True)] == [(b, t, joined(b, t)) for _, b, t in pairs]
    assert session.createDataFrame([("mailto:x@y.z", "http://a.net/")], "t string, u string").select(url_filter.absolute_url(F.col("t"), F.col("u"))).first()[0] is None


def test_links_that_count(session):
    """Comments and scripts hide links, base moves them, queries and dot segments are resolved."""
    rows = [
        (1, "http://a.net/f/p.html", "<base href='/de/'><link rel=canonical href='x'>"),
        (2, "http://b.net/q/p.html", '<link title="a > b" rel="nofollow canonical" href="../de/x">'),
        (3, "http://c.net/de?q=1", None),
        (4, "http://c.net/p", "<meta content='5; URL=\"de?q=1\"' http-equiv=Refresh>"),
        (5, "http://d.net/1", "<!-- <link rel=canonical href=/de/x> --><script>'<link rel=canonical href=/de/x>'</script>"),
        (6, "http://e.net/1", "<link rel=alternate href=/de/x><link data-rel=canonical href=/de/x>"),
        (7, "http://f.net/" + "z" * 200_000, "<link rel=canonical href=/de/x>"),
        (7, "http://f.net/" + "z" * 200_000, "<link rel=canonical href=/de/x>"),
        (None, "http://g.net/", "<link rel=canonical href=/de/x><!-- open"),
    ]
    rules = session.createDataFrame([("block", "net", "/de")], url_filter.RULES)
    pages = session.createDataFrame([(*r, "h", "n") for r in rows], "page_id long, url string, html string, host string, node string")
    found = Counter((r["page_id"], r["verdict"], r["by"]) for r in url_filter.judge_urls(pages, rules).collect())
    block = [(1, "alias"), (2, "alias"), (3, "rule"), (4, "alias"), (7, "alias"), (7, "alias"), (None, "alias")]
    assert found == Counter([*((i, "block", by) for i, by in block), (5, "allow", "default"), (6, "allow", "default")])
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_personal_data(session):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0

    def base(text):
        for k, (kind, pattern) in enumerate(plain.items()):
            for m in re.finditer(pattern, text or ""):
                d = re.sub("[^0-9]", "", m.group())
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                    yield m.start(), k, f"{kind}:{m.start()}:{m.end()}"

    r = random.Random(4)
    texts = ["".join(r.choices("a1 2-3.4+@()9,é😀\n0x", k=r.randint(0, 80))) for _ in range(400)]
    texts += [None, "", "1" * 5000 + " " + "a." * 3000 + "@" + "b." * 3000, "x@y.z+d@e.f 1.2.3.4.5.6.7.8 300.1.1.1 001.002.0255.4 4111 1111 1111 1111"]
    # eight known mails stand behind one phrase, and so does an identifier of no known kind
    texts += [f"contact me at user{i}@mail.example now" for i in range(8)] + ["contact me at QX77-81923-ZZ now"]
    found = {x["doc_id"]: x for x in pii.digest(pii.personal_data(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    for i, text in enumerate(texts):
        want = ",".join(s for *_, s in sorted(base(text)))
        assert found[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), text
    assert found[len(texts) - 1]["spans"] == "id:14:27"


def test_licences(session):
    docs = session.createDataFrame([(1, "abc\nReleased under the MIT Licence!\nxyz"), (2, None), (3, ""), (4, "word"), (5, "nothing of the kind here")], "doc_id long, text string")
    assert [(r["doc_id"], r["scope"], r["unit"], r["license_id"], r["dice"]) for r in licences.scan_licences(docs).collect()] == [(1, "line", 1, "MIT", 1.0)]


def test_language_id_held_out(session):
    docs = session.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(langid.labelled_documents(docs.where("doc_id % 2 = 0")))
    found = langid.identify(langid.document_evidence(docs.where("doc_id % 2 = 1").selectExpr("doc_id", "text", "lang as truth", "cast(null as string) as lang", "source")), model).selectExpr("avg(cast(lang = row.truth as int))").first()[0]
    assert found > 0.97
    odd = session.createDataFrame([(1, None, "en", "s"), (2, "", None, None), (3, "12 34 !", "en", "a.de")], "doc_id long, text string, lang string, source string")
    assert {r["lang"] for r in langid.identify(langid.document_evidence(odd), model).collect()} == {"und"}


def test_pipeline_stages_keep_columns_and_take_empty_tables(session, rows):
    docs = session.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(session, docs, "/root/testdata/sf0.001").columns == docs.columns
    assert corpus_pipeline.STAGES[2][1](session, docs.limit(0), "").count() == 0
