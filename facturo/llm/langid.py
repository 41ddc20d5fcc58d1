"""Language identification by Bayesian evidence fusion (dealt operator 4).

Evidence about a text's language, multiplied as independent likelihoods:

- the text: character trigrams under a model per language, and under a flat
  model for "und" (no known language);
- the declared language (markup attribute, or a column): P(declared | language);
- the address suffix of the host: P(suffix | language);
- the host: P(language | host), smoothed towards its domain's distribution,
  and that towards the corpus'.

The trigram models are fitted on about ``SAMPLE_ROWS`` rows of each label,
chosen by a hash of doc_id and text, so every label with ``LEAST_ROWS`` rows in
the whole table and some trigram has a model, however rare it is. All other tables are grouped sums over every row, of the
language that the text alone speaks for; sums are combined in each task, so a
host with a third of all rows is no hot spot, and the tables are joined back by
``sized_join``.

Cases: null and empty texts, and texts without letters, are "und" and not
kept; a null declaration, host or suffix is no evidence; repeated rows count
and are judged alike; an empty table, or one without labels, has no language,
so its rows are "und".
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, packed, sized_join, sliced

#: Rows of each label that its trigram model is fitted on (about), and least rows of a label in the table.
SAMPLE_ROWS, LEAST_ROWS = 5000, 5
#: Hash buckets of trigrams.
BUCKETS = 1 << 15
#: A text counts as at most so many independent trigrams.
EVIDENCE = 60
#: Weight, in rows, of the coarser distribution in a smoothed one.
SMOOTHING = 20.0
#: Prior share of texts in no known language.
UNKNOWN = 1e-3
#: Tasks that count the sample's trigrams.
COUNTING_TASKS = 32
_BLOCK = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point of each letter, 32 for any other character."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    letters = np.flatnonzero(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    out[letters] = letters
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram with at most one non-letter, and the text of each."""
    joined = "  ".join(["", *(t.lower() for t in texts), ""])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _letters()[raw].astype(np.uint64)
    blank = codes == 32
    useful = blank[:-2].astype(np.int8) + blank[1:-1] + blank[2:] < 2
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    at = np.flatnonzero(useful)
    # texts are apart by two blanks, so no trigram holds letters of two
    ends = np.cumsum([len(t.lower()) + 2 for t in texts])
    return (mixed[at] >> np.uint64(49)).astype(np.int64), np.searchsorted(ends, at, side="right").clip(0, max(0, len(texts) - 1))


def _pieces(text: str) -> list[str]:
    return [text[i : i + _BLOCK + 2] for i in range(0, max(1, len(text) - 2), _BLOCK)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages + 1) log probabilities; the last column is "und"

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of trigrams and summed log likelihoods of whole texts; long ones piece by piece."""
        n, total = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), self.table.shape[1]))
        held, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(text or ""):
                held.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= _BLOCK:
                    self._add(held, owners, n, total)
                    held, owners, size = [], [], 0
        if held:
            self._add(held, owners, n, total)
        return n, total

    def _add(self, pieces: list[str], owners: list[int], n: np.ndarray, total: np.ndarray) -> None:
        bucket, piece = trigrams(pieces)
        count = np.bincount(piece, minlength=len(pieces))
        np.add.at(n, owners, count)
        some = np.flatnonzero(count)
        if len(some):
            starts = np.searchsorted(piece, some)
            np.add.at(total, np.array(owners)[some], np.add.reduceat(self.table[bucket], starts, axis=0))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> Model:
    """Trigram models of all labels of ``labelled`` (text, label, and what else tells its rows apart).

    Of a label with more rows, about 1.2 * ``sample_rows`` are chosen by their
    hash; of repeated rows, which share it, one stands for all.
    """
    known = labelled.where("text is not null and label is not null").withColumn("key", F.xxhash64(*labelled.columns, F.lit(seed)))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("key", 0.02).alias("different")).where(F.col("rows") >= LEAST_ROWS)
    shares = [(r["label"], min(1.0, 1.2 * sample_rows / max(1, r["different"]))) for r in sizes.collect()]  # a row per language
    if not shares:
        return Model([], np.full((BUCKETS, 1), -math.log(BUCKETS), dtype=np.float32))
    wanted = labelled.sparkSession.createDataFrame(shares, "label string, share double")
    chosen = sized_join(known.select("text", "label", "key"), wanted, ["label"], "inner", rows=len(shares))
    sample = chosen.where(F.expr("(key & 9007199254740991) / 9007199254740992D < share")).dropDuplicates(["label", "key"]).coalesce(COUNTING_TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches, "text", _BLOCK):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                into = sums.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
                for piece in _pieces(text):
                    into += np.bincount(trigrams([piece])[0], minlength=BUCKETS)
        for label, x in sums.items():
            yield pa.RecordBatch.from_pydict({"label": [label], "counts": [x.tobytes()]}, schema=schema)

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in parts.column("counts").to_pylist())
        return pa.Table.from_pydict({"label": parts.column("label")[:1], "counts": [total.tobytes()]}, schema=schema)

    schema = pa.schema([("label", pa.string()), ("counts", pa.binary())])
    summed = sample.select("text", "label").mapInArrow(count, "label string, counts binary").groupBy("label").applyInArrow(add, "label string, counts binary")
    counts = {r["label"]: np.frombuffer(r["counts"], dtype=np.int64) for r in summed.collect()}  # a row per language
    languages = sorted(x for x in counts if counts[x].any())
    table = np.full((BUCKETS, len(languages) + 1), -math.log(BUCKETS), dtype=np.float32)
    for k, x in enumerate(languages):
        table[:, k] = np.log((counts[x] + 0.02) / (counts[x].sum() + 0.02 * BUCKETS))
    return Model(languages, table)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Written table of ``docs`` (text, declared, host and others) without text, with its evidence per class (``ll``) and the class it speaks for (``best``)."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("letters", T.LongType()), T.StructField("ll", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            n, total = shared.value.scores(batch.column("text").to_pylist())
            # a long text weighs as EVIDENCE trigrams
            total *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            width = total.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, width, dtype=np.int32)), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(n), lists], names=[*(f.name for f in kept), "letters", "ll"])

    table = docs.mapInArrow(run, schema)
    labels = F.lit([*model.languages, "und"])
    best = F.when(F.col("letters") > 0, F.element_at(labels, F.array_position("ll", F.array_max("ll")).cast("int"))).otherwise("und")
    return materialize(table.withColumn("best", best), docs.sparkSession, "text-evidence")


def host_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.when(host != "", F.substring_index(host, ".", -2))


def host_suffix(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def _votes(rows: DataFrame, key: str, languages: list[str]) -> DataFrame:
    """(key, votes): how many rows of each key speak for each language."""
    sums = [F.sum(F.when(F.col("best") == x, 1.0).otherwise(0.0)).alias(f"v{i}") for i, x in enumerate(languages)]
    grouped = rows.where(F.col(key).isNotNull() & (F.col("best") != "und")).groupBy(key).agg(*sums)
    return grouped.select(key, F.array(*[f"v{i}" for i in range(len(languages))]).alias("votes"))


def _likelihoods(rows: DataFrame, key: str, languages: list[str], totals: list[float]) -> DataFrame:
    """(key, log): log P(key | language), smoothed by one row spread over the values seen."""
    votes = _votes(rows, key, languages)
    values = max(1, votes.count())
    per = [F.log((F.col("votes")[i] + 1.0 / values) / F.lit(t + 1.0)) for i, t in enumerate(totals)]
    return votes.select(key, F.array(*per).alias(f"{key}_log"))


def _smoothed(votes: str, coarse: list[Column], i: int) -> Column:
    total = F.aggregate(votes, F.lit(0.0), lambda x, y: x + y)
    return (F.col(votes)[i] + SMOOTHING * coarse[i]) / (total + SMOOTHING)


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Add lang and posterior to scored rows; drops the working columns."""
    if not languages:
        return rows.withColumn("lang", F.lit("und")).withColumn("posterior", F.lit(1.0)).drop("ll", "best")
    keyed = rows.withColumn("host", F.when(F.col("host") != "", F.col("host"))).withColumn("domain", host_domain(F.col("host"))).withColumn("suffix", host_suffix(F.col("host")))
    spoken = keyed.where("best <> 'und'").groupBy("best").agg(F.count(F.lit(1)).alias("n"))
    by_language = {r["best"]: float(r["n"]) for r in spoken.collect()}  # a row per language
    totals = [by_language.get(x, 0.0) for x in languages]
    corpus = [F.lit((t + 1.0) / (sum(totals) + len(totals))) for t in totals]

    domains = _votes(keyed, "domain", languages)
    domains = domains.select("domain", F.array(*[_smoothed("votes", corpus, i) for i in range(len(languages))]).alias("domain_share"))
    hosts = _votes(keyed, "host", languages).withColumn("domain", host_domain(F.col("host")))
    hosts = sized_join(hosts, domains, ["domain"])
    coarse = [F.coalesce(F.col("domain_share")[i], corpus[i]) for i in range(len(languages))]
    spark = rows.sparkSession
    hosts = materialize(hosts.select("host", F.array(*[_smoothed("votes", coarse, i) for i in range(len(languages))]).alias("host_share")), spark, "host-priors")
    declared = _likelihoods(keyed, "declared", languages, totals)
    suffixes = _likelihoods(keyed, "suffix", languages, totals)

    joined = keyed
    for table, key in ((hosts, "host"), (declared, "declared"), (suffixes, "suffix")):
        joined = sized_join(joined, table, [key])
    size = len(languages)
    logs = []
    for i in range(size):
        prior = F.log(F.coalesce(F.col("host_share")[i], corpus[i]) * (1 - UNKNOWN))
        logs.append(F.col("ll")[i] + prior + F.coalesce(F.col("declared_log")[i], F.lit(0.0)) + F.coalesce(F.col("suffix_log")[i], F.lit(0.0)))
    # no known language: a declaration or suffix is as likely as on average over languages
    mean = lambda name: F.coalesce(sum(F.col(name)[i] for i in range(size)) / size, F.lit(0.0))
    logs.append(F.col("ll")[size] + math.log(UNKNOWN) + mean("declared_log") + mean("suffix_log"))
    fused = joined.withColumn("fused", F.array(*logs)).withColumn("most", F.array_max("fused"))
    share = F.lit(1.0) / F.aggregate(F.transform("fused", lambda x: F.exp(x - F.col("most"))), F.lit(0.0), lambda x, y: x + y)
    labels = F.lit([*languages, "und"])
    lang = F.when(F.col("letters") > 0, F.element_at(labels, F.array_position("fused", F.col("most")).cast("int"))).otherwise("und")
    out = fused.withColumn("lang", lang).withColumn("posterior", F.when(F.col("letters") > 0, share).otherwise(1.0))
    return out.select(*[c for c in rows.columns if c not in ("ll", "best")], "lang", "posterior")


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as (row, text, declared, host): the lang column declares, the source is the host."""
    return packed(docs, text="cast(text as string)", declared="cast(lang as string)", host="cast(source as string)")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as (row, text, declared, host): markup's lang attribute, visible text, the URL's host."""
    from .url_filter import url_host

    markup = F.coalesce(F.col("html").cast("string"), F.lit(""))
    hidden = r"(?is)<(script|style)\b[^<>]*>.*?</\1\s*>|<!--.*?-->|<[^<>]*>"
    text = F.regexp_replace(F.regexp_replace(markup, hidden, " "), "&[#A-Za-z0-9]{1,10};", " ")
    declared = F.lower(F.regexp_extract(markup, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    return pages.select(row.alias("row"), text.alias("text"), F.when(declared != "", declared).alias("declared"), url_host(F.col("url").cast("string")).alias("host"))


def identify(evidence: DataFrame, model: Model) -> DataFrame:
    """lang, posterior, letters and the evidence of every row; other columns of ``evidence`` pass through, text does not."""
    return fuse(scored(evidence, model), model.languages)


def drop_unidentified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (text, lang, source) whose text is in a known language, with all their columns."""
    return identify(document_evidence(docs), model).where("lang <> 'und'").select("row.*")


def labelled_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("label"))
