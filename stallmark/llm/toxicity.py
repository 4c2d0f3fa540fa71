"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and their four- and five-letter beginnings, hashed to
32 bits. The machine adds a weight for each term and, through factors, one for each pair of
terms, so a pair can count for more than its two terms. It is fitted on a bounded sample of
labelled rows (`SAMPLE_ROWS`, the only bound): every term of it whose own chi-squared value reaches `MIN_CHI2` takes part and,
so that a term which is neutral alone and counts beside another is kept, every term of a pair whose share of
positive labels reaches `MIN_PAIR_RATIO`; others carry no evidence in the sample and weigh nothing. The fit does not depend on the order
of the rows.

Defined cases: null and empty texts have no terms and score the machine's bias; terms count once
however often they occur; repeated rows score alike; without labels of both kinds the score is the
smoothed share of positive labels; further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fold, shared_folder, written
from .hash_arrays import Arrays, by_bucket, save
from .sampling import HELD_OUT_PARTS, labelled_sample, sampled_features

SAMPLE_ROWS = 20_000
MIN_CHI2 = 12.0
#: Least likelihood ratio (2 ln) of a pair's share of positive labels against that of either term alone.
MIN_PAIR_RATIO = 40.0
#: Terms that a task compares with all others at a time, and sampled rows whose terms one stored file holds.
PAIR_BLOCK, POSTING_ROWS = 128, 2_500
FACTORS = 8
EPOCHS = 12
CACHE = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> tuple[int, ...]:
    """The hashed terms of one lower-cased word."""
    b = word.encode()
    out = [crc32(b"w" + b)]
    for n in (4, 5):
        if len(word) >= n:
            out.append(crc32(b"p" + word[:n].encode()))
    return tuple(out)


def text_terms(text: str | None) -> set[int]:
    return {t for w in set(_WORD.findall((text or "").lower())) for t in word_terms(w)}


@dataclass
class Machine:
    """Bias, sorted term hashes with weights, and factors (terms x FACTORS)."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, docs: list[list[int]]) -> np.ndarray:
        """The log-odds of documents given as lists of places in `terms`."""
        flat, owner = _flat(docs)
        n = len(docs)
        linear = np.bincount(owner, self.weights[flat], n)
        sums = np.stack([np.bincount(owner, self.factors[flat, k], n) for k in range(self.factors.shape[1])], 1)
        squares = np.bincount(owner, (self.factors[flat] ** 2).sum(1), n)
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - squares)


def _flat(docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.fromiter((x for d in docs for x in d), np.int64, int(sizes.sum()))
    return flat, np.repeat(np.arange(len(docs)), sizes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def term_counts(found: DataFrame) -> DataFrame:
    """(term, df, pos): the rows that hold each term, and the positive ones of these, over (terms, label) rows."""
    return found.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"), F.sum("label").alias("pos"))


def screen(found: DataFrame, least: float = MIN_CHI2, counts: DataFrame | None = None) -> np.ndarray:
    """The sorted terms whose presence depends on the label, by chi-squared (corrected for continuity, so that few rows show little) over (terms, label) rows."""
    n, p = found.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < p < n:
        return np.zeros(0, np.int64)
    expected = F.col("df") * (p / n)
    spread = expected * (1 - p / n) * (n - F.col("df")) / max(n - 1, 1)
    apart = F.greatest(F.abs(F.col("pos") - expected) - 0.5, F.lit(0.0))
    best = (term_counts(found) if counts is None else counts).where(apart * apart / F.greatest(spread, F.lit(1e-9)) >= least)
    return best.select("term").orderBy("term").toArrow().column("term").to_numpy().astype(np.int64)


def placed(found: DataFrame, terms: np.ndarray) -> DataFrame:
    """(places, label) of each row: where its terms are in `terms`, which are sorted."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offs = b.column(0).offsets.to_numpy()
            flat = b.column(0).flatten().to_numpy()
            at = np.searchsorted(terms, flat)
            at[at == len(terms)] = 0
            hit = terms[at] == flat if len(terms) else np.zeros(len(flat), bool)
            upto = np.append(0, np.cumsum(hit))[offs - offs[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(upto, pa.array(at[hit], pa.int32())), b.column(1)], names=["places", "label"])

    return found.select("terms", "label").mapInArrow(place, "places array<int>, label int")


def postings(rows: DataFrame, terms: int, files: int) -> Arrays:
    """The (places, label) rows dealt over files in the shared folder: each has its rows' places and, by place, the rows that hold it."""
    folder = shared_folder(rows.sparkSession, "postings")

    def store(t: pa.Table) -> pa.Table:
        bucket = int(t.column("bucket")[0].as_py())
        places = t.column("places").combine_chunks()
        places = places.combine_chunks() if isinstance(places, pa.ChunkedArray) else places
        flat, offs = places.flatten().to_numpy().astype(np.int32), places.offsets.to_numpy().astype(np.int64)
        offs = offs - offs[0]
        order = np.argsort(flat, kind="stable")
        holder = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))[order]
        start = np.searchsorted(flat[order], np.arange(terms + 1))
        save(folder, str(bucket), flat=flat, offs=offs, holder=holder, start=start, label=t.column("label").to_numpy().astype(np.int8))
        return pa.table({"n": pa.array([bucket], pa.int64())})

    dealt = rows.withColumn("bucket", (F.monotonically_increasing_id() % files).cast("int"))  # evaluated once, in the one job below
    return Arrays(folder, files, [r.n for r in by_bucket(dealt, files, store, "n long").collect()])  # a row for each file


def pair_ratio(both: np.ndarray, pos: np.ndarray, a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """2 ln of the likelihood ratio of pairs in `both` rows, `pos` of them positive, where that share is above or below
    all of: the shares a and b of the terms alone, and p; else 0."""
    k, m = pos, np.maximum(both, 1)
    share = k / m
    high, low = np.maximum(np.maximum(a, b), p), np.minimum(np.minimum(a, b), p)
    q = np.where(share > high, high, np.where(share < low, low, share))
    with np.errstate(divide="ignore", invalid="ignore"):
        up, down = np.where(k > 0, k * np.log(share / q), 0), np.where(m > k, (m - k) * np.log((1 - share) / (1 - q)), 0)
    return np.where(both > 0, 2 * (up + down), 0)


def screen_pairs(found: DataFrame, least: float = MIN_PAIR_RATIO, counts: DataFrame | None = None, posting_rows: int = POSTING_ROWS) -> np.ndarray:
    """The sorted terms of pairs that say more of the label than either term.

    A pair of k positive rows reaches at most 2 k ln(1 / p), so rarer terms are left out without loss (likewise
    for negative rows). All pairs of the rest are counted, a block of terms in a task's memory at a time; the
    rows lie in files that the tasks map, the driver holds the terms only.
    """
    n, p = found.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < p < n:
        return np.zeros(0, np.int64)
    share = p / n
    enough = (F.col("pos") >= least / (-2 * np.log(share))) | (F.col("df") - F.col("pos") >= least / (-2 * np.log(1 - share)))
    got = (term_counts(found) if counts is None else counts).where(enough).select("term", "df", "pos").toArrow().sort_by("term")
    terms, df, pos = (got.column(c).to_numpy().astype(np.int64) for c in ("term", "df", "pos"))
    if len(terms) < 2:
        return np.zeros(0, np.int64)
    files = -(-n // posting_rows)
    stored, alone = postings(placed(found, terms), len(terms), files), (pos + share) / (df + 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [own for k in range(files) if (own := stored.columns(k))]
        m = len(alone)
        for batch in batches:
            for block in batch.column(0).to_numpy():
                lo, hi = int(block) * PAIR_BLOCK, min((int(block) + 1) * PAIR_BLOCK, m)
                both, pos = np.zeros((hi - lo, m), np.int32), np.zeros((hi - lo, m), np.int32)
                for a in range(lo, hi):
                    of = {1: [], 0: []}
                    for own in parts:
                        flat, offs, label = own["flat"], own["offs"], own["label"]
                        for d in own["holder"][own["start"][a] : own["start"][a + 1]]:
                            of[label[d]].append(flat[offs[d] : offs[d + 1]])
                    for kind, lists in of.items():
                        if lists:
                            c = np.bincount(np.concatenate(lists), minlength=m)
                            both[a - lo] += c
                            if kind:
                                pos[a - lo] = c
                ratio = pair_ratio(both, pos, alone[lo:hi, None], alone[None], share)
                ratio[np.arange(hi - lo), np.arange(lo, hi)] = 0
                keep = np.flatnonzero(ratio.max(1) >= least)
                yield pa.RecordBatch.from_arrays([pa.array(lo + keep, pa.int64())], names=["at"])

    blocks = -(-len(terms) // PAIR_BLOCK)
    best = found.sparkSession.range(0, blocks, 1, min(blocks, 64)).mapInArrow(compare, "at long")
    return terms[np.sort(best.toArrow().column("at").to_numpy())]


def fit(places: list[np.ndarray], y: np.ndarray, terms: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fits by AdaGrad on the logistic loss; places say which of `terms` each document has."""
    y = np.asarray(y, float)
    prior = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(seed)
    m = Machine(float(np.log(prior / (1 - prior))), terms, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), factors)))
    if not len(terms):
        return m
    g_bias, g_w, g_v = 1e-6, np.full(len(terms), 1e-6), np.full((len(terms), factors), 1e-6)
    decay = 1e-5
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), 64):
            rows = order[lo : lo + 64]
            flat, owner = _flat([places[r] for r in rows])
            v = m.factors[flat]
            sums = np.zeros((len(rows), factors))
            np.add.at(sums, owner, v)
            raw = m.bias + np.bincount(owner, m.weights[flat], len(rows)) + 0.5 * ((sums**2).sum(1) - np.bincount(owner, (v**2).sum(1), len(rows)))
            e = _sigmoid(raw) - y[rows]
            g = e.sum() / len(rows)
            g_bias += g * g
            m.bias -= 0.3 * g / np.sqrt(g_bias)
            own, inverse = np.unique(flat, return_inverse=True)
            gw = np.bincount(inverse, e[owner], len(own)) / len(rows) + decay * m.weights[own]
            gv = np.zeros((len(own), factors))
            np.add.at(gv, inverse, e[owner, None] * (sums[owner] - v) / len(rows))
            gv += decay * m.factors[own]
            g_w[own] += gw**2
            g_v[own] += gv**2
            m.weights[own] -= 0.3 * gw / np.sqrt(g_w[own])
            m.factors[own] -= 0.05 * gv / np.sqrt(g_v[own])
    return m


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits the machine on the labelled rows that are not held out, at most sample_rows of them.

    Terms are counted and screened in Spark; of each sampled document only its screened terms reach the driver.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                found = [sorted(text_terms(t)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), part.column(1).cast(pa.int32())], names=["terms", "label"])

    found = written(sampled_features(docs, labelled_sample(labels, "toxic", sample_rows), extract, "terms array<long>, label int"), "terms")
    counts = written(term_counts(found), "counts")
    terms = np.union1d(screen(found, counts=counts), screen_pairs(found, counts=counts))
    got = placed(found, terms).toArrow()
    # In an order of their own: that of the files differs with the partitions.
    rows = sorted(zip((x.tobytes() for x in got.column("places").to_numpy()), got.column("label").to_pylist()))
    return fit([np.frombuffer(x, np.int32) for x, _ in rows], np.array([y for _, y in rows]), terms)


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Adds `score`, the probability that the text is toxic, to every row."""
    names = docs.columns
    kept = [k for k, n in enumerate(names) if n != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {int(t): k for k, t in enumerate(machine.terms)}
        cache: dict[str, tuple[int, ...]] = {}
        for b in batches:
            found = []
            for t in b.column(names.index(text)).to_pylist():
                own: set[int] = set()
                for w in set(_WORD.findall((t or "").lower())):
                    at = cache.get(w)
                    if at is None:
                        if len(cache) >= CACHE:
                            cache.clear()
                        at = cache[w] = tuple(place[x] for x in word_terms(w) if x in place)
                    if at:
                        own.update(at)
                found.append(sorted(own))
            s = _sigmoid(machine.raw(found)) if len(machine.terms) else np.full(len(found), _sigmoid(np.float64(machine.bias)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(s, pa.float64())], names=[*(f"c{k}" for k in kept), "score"])

    # Columns go by their place, as mapInArrow does not take every name.
    schema = StructType([*(StructField(f"c{k}", docs.schema[k].dataType) for k in kept), StructField("score", DoubleType())])
    return docs.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(run, schema).toDF(*(names[k] for k in kept), "score")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    machine = train(docs, labels, sample_rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", HELD_OUT_PARTS) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return score(own, machine).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
