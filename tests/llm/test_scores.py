"""Scores against brute force, decisions at their thresholds, and results that do not depend on how rows are dealt out."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallmark.llm import quality, top_k, toxicity, url_filter


@pytest.fixture(scope="module")
def corpus(spark, sf):
    folder = sf.replace("0.001", "0.01")
    return [spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels")]


def brute_force_score(machine, text):
    """Weights of the terms and, pair by pair, the products of their factors."""
    place = {int(t): k for k, t in enumerate(machine.terms)}
    terms = {t for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for t in toxicity.word_terms(w)}
    own = sorted(place[t] for t in terms if t in place)
    raw = machine.bias + sum(float(machine.weights[a]) for a in own) + sum(float(np.dot(machine.factors[a], machine.factors[b])) for a, b in itertools.combinations(own, 2))
    return 1 / (1 + math.exp(-min(max(raw, -30), 30)))


def test_scores_of_the_machine_by_pairs(spark, corpus):
    docs, labels = corpus
    machine = toxicity.train(docs, labels)
    assert len(machine.terms) > 10
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()] + ["", None, "word " * 50_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, machine).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx([brute_force_score(machine, t) for t in texts], abs=1e-9)
    assert any(s >= 0.5 for s in got.values()) and got[len(texts) - 3] == got[len(texts) - 2]


@pytest.mark.parametrize(("operator", "threshold"), [(toxicity.toxicity, 0.5), (quality.quality, 0.3)])
def test_predicted_and_held_out(corpus, operator, threshold):
    docs, labels = corpus
    label = "toxic" if operator is toxicity.toxicity else "quality"
    rows = operator(docs, labels).join(labels, "doc_id").collect()
    assert all(r.predicted == int(r.score >= threshold) for r in rows) and {r.predicted for r in rows} == {0, 1}
    crc = {r.doc_id: r.m for r in docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).alias("m")).collect()}
    assert all(r.held_out == (crc[r.doc_id] == 0) for r in rows)
    held = [r for r in rows if r.held_out and r[label] is not None]
    right = sum(r.predicted == r[label] for r in held)
    assert right >= 0.9 * len(held)


def test_toxicity_whatever_the_partitions(corpus):
    docs, labels = corpus
    one = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    other = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(7, F.reverse("text")), labels.repartition(3)).collect()}
    assert one == other


def test_every_term_with_evidence_takes_part(spark):
    """Many terms mark the label equally well: none is left out for their number."""
    rows = [([*range(k % 2 * 6000, k % 2 * 6000 + 6000)], k % 2) for k in range(40)]
    found = spark.createDataFrame(rows, "terms array<long>, label int")
    assert toxicity.screen(found).tolist() == list(range(12_000))
    rare = spark.createDataFrame([([1, 2] if k < 2 else [2], int(k < 5)) for k in range(40)], "terms array<long>, label int")
    assert toxicity.screen(rare).tolist() == []  # two rows are no evidence, nor is a term of all rows


@pytest.mark.parametrize("posting_rows", [7, 100, 10_000])
def test_pair_screen_by_brute_force(spark, posting_rows):
    """Every pair of terms, counted row by row, whatever number of files holds the rows; equal rows and rows without terms among them."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        own = set(rng.choice(60, 8, replace=False).tolist()) if k % 9 else set()
        rows.append((sorted(own), int({1, 2} <= own or {5, 6, 7} <= own or k % 11 == 0 and 3 in own)))
    rows += [([1, 2, 40], 1)] * 30 + [([1, 50], 0)] * 30 + [([2, 51], 0)] * 30
    share = sum(y for _, y in rows) / len(rows)
    df, pos = {}, {}
    for own, y in rows:
        for t in itertools.chain(own, itertools.combinations(own, 2)):
            df[t], pos[t] = df.get(t, 0) + 1, pos.get(t, 0) + y
    alone = {t: (pos[t] + share) / (df[t] + 1) for t in df}
    want = set()
    for a, b in (t for t in df if isinstance(t, tuple)):
        got = toxicity.pair_ratio(np.array([df[a, b]]), np.array([pos[a, b]]), np.array([alone[a]]), np.array([alone[b]]), share)[0]
        want |= {a, b} if got >= 10 else set()
    found = spark.createDataFrame(rows, "terms array<long>, label int").repartition(3)
    assert {1, 2} <= want and len(want) < 60
    assert toxicity.screen_pairs(found, 10, posting_rows=posting_rows).tolist() == sorted(want)


def test_empty_vectors_take_part(spark):
    df = spark.createDataFrame([(0, []), (100, [1.0, -1.0]), (1, [-0.5, 0.0]), (2, []), (3, None)], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k.top_k(df).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 2, 0), (0, 3, 100, 0), (100, 1, 0, 0), (100, 2, 2, 0), (100, 3, 1, -512 * 1024)]
    only = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k.top_k(only).collect()] == [(0, 1, 1, 0)]


def test_very_long_urls(spark):
    long = "a" * 1_000_000
    rows = [(1, f"http://{long}.Net/es/{long}?{long}"), (2, f"http://x.org/{long}#{long}"), (3, long), (4, f"{long}://y.com")]
    got = {r.page_id: r for r in url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == (f"{long}.net", f"/es/{long}", "net/es/", "block")
    assert (got[2].host, got[2].path) == ("x.org", f"/{long}") and (got[3].host, got[3].path) == ("", "") and (got[4].host, got[4].path, got[4].rule) == ("y.com", "", None)


def test_urls_are_parsed_once(spark, sf):
    """The result reads what was stored, not the pages."""
    files = url_filter.url_filter(spark.read.parquet(f"{sf}/pages.parquet")).inputFiles()
    assert files and not [f for f in files if "pages.parquet" in f]
