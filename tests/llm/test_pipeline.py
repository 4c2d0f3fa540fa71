"""The pipeline against a brute-force version of its later stages."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from stallmark.llm import packing, quality, set_join
from stallmark.llm.common import written

from .test_operators import brute_removed, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = "A train leaves the old station with 120 passengers and Peter counts 45 km before Peter reaches the next town on the river"
GOOD = "The quiet river runs past {} old houses, and people walk there in the evening, talking about work and weather and {} other things."
BAD = "!!! $$$ BUY {} NOW http {} %%% ### @@@ 111 222 333 !!! !!!"
#: doc_id, text, and columns that clash with names that the stages use.
SCHEMA = "doc_id long, text string, quality_score int, ROW string, score double, `a.b` string, component_id long"


def rows():
    """Nulls in every column, empty and very long texts, copies, edited copies, repeated rows, rows without an id, a benchmark item."""
    rng = np.random.default_rng(8)
    out = [(k, t) for k, t in enumerate(texts())]
    words = [f"{a}{b}" for a in ("sun", "rain", "wind", "stone", "tree") for b in ("light", "fall", "mill", "wall", "house")]
    prose = lambda n: " ".join(rng.choice(words, n))
    long_ = prose(200)
    out += [(None, long_), (900, long_), (None, long_), (901, long_), (900, long_)]  # one group: 900 stays, once
    out += [(None, "only " + prose(60))] * 2  # a group without ids: one stays
    out += [(910, f"{prose(20)}. {ITEM}. {prose(20)}"), (None, f"{prose(20)}. {ITEM}. {prose(20)}"), (911, " ".join(f"w{k % 977}" for k in range(40_000)))]
    out += [(1000 + k, GOOD.format(prose(12), prose(9))) for k in range(60)] + [(1100 + k, BAD.format(k * 7, k * 13)) for k in range(60)]
    return [(k, t, None if n % 3 else n, f"r{n}", None if n % 2 else 0.5, None if n % 5 else "x", n) for n, (k, t) in enumerate(out)]


@pytest.fixture(scope="module")
def hard(spark, tmp_path_factory):
    """A folder of tables with the rows above, and one with the same tables without rows."""
    full, none = (str(tmp_path_factory.mktemp(n)) for n in ("full", "none"))
    labels = [(1000 + k, 1) for k in range(60)] + [(1100 + k, 0) for k in range(60)] + [(None, 1), (5, None)]
    for folder, keep in ((full, 10_000), (none, 0)):
        spark.createDataFrame(rows(), SCHEMA).limit(keep).repartition(3).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(k, q, None) for k, q in labels], "doc_id long, quality int, toxic int").limit(keep).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").limit(keep).write.parquet(f"{folder}/benchmark.parquet")
    return full, none


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_hard_cases_of_every_stage(spark, hard):
    """Each stage against a brute-force version, on the rows that the stage before kept; run() gives the last one's rows."""
    full, _ = hard
    read = lambda df: written(df, "test")
    docs = spark.read.parquet(f"{full}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{full}/labels.parquet"))
    kept = read(corpus_pipeline.quality_stage(spark, docs, full))
    assert kept.columns == docs.columns
    got = docs.collect()
    p = model.probability(quality.statistics(pa.array([r.text for r in got], pa.string())))
    assert plain(kept) == sorted((tuple(r) for r, x in zip(got, p) if x >= 0.3), key=str)
    ids = {r.doc_id for r in kept.collect()}
    assert sum(1000 + k in ids for k in range(60)) >= 57 and sum(1100 + k in ids for k in range(60)) <= 3

    docs = read(docs)  # all rows go on, so that every case meets the later stages
    out = read(corpus_pipeline.near_duplicate_stage(spark, docs, full))
    got = docs.collect()
    sets, group = [shingles(r.text) for r in got], list(range(len(got)))
    for a in range(len(got)):
        for b in range(a):
            if group[a] != group[b] and linked(sets[a], sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {}
    for k, g in enumerate(group):
        best = (got[k].doc_id is None, got[k].doc_id or 0, k)
        first[g] = min(first.get(g, best), best)
    assert out.columns == docs.columns and plain(out) == sorted((tuple(got[k]) for _, _, k in first.values()), key=str)
    assert [r.doc_id for r in out.collect() if r.doc_id in (900, 901)] == [900]

    docs, out = out, read(corpus_pipeline.repeated_bytes_stage(spark, out, full))
    got = sorted((r for r in docs.collect() if r.doc_id is not None), key=lambda r: r.doc_id)
    want = {got[k].doc_id: None if got[k].text is None else bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for k, (b, gone) in brute_removed([r.text for r in got]).items()}
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect() if r.doc_id is not None} == want
    assert plain(out.where("doc_id is null")) == plain(docs.where("doc_id is null"))

    docs, out = out, read(corpus_pipeline.decontamination_stage(spark, out, full))
    assert out.columns == docs.columns and plain(out) == sorted((tuple(r) for r in docs.collect() if r.doc_id is None or ITEM not in (r.text or "")), key=str)
    assert docs.where("doc_id = 910").count() == 1 and out.where("doc_id = 910").count() == 0

    packed = read(corpus_pipeline.packing_stage(spark, out, full)).collect()
    want = []
    for r in out.collect():
        ids = packing.token_ids(r.text)
        want += [(r.doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cuts(len(ids)))]
    assert sorted((tuple(r)[:5] for r in packed), key=str) == sorted(want, key=str)
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    whole = corpus_pipeline.run(spark, full).collect()
    assert {r.doc_id for r in whole} <= {r.doc_id for r in packed} and len(whole) > 0


def test_every_stage_of_an_empty_table(spark, hard):
    _, none = hard
    docs = spark.read.parquet(f"{none}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, none), "test")
        assert docs.count() == 0, name
    assert corpus_pipeline.run(spark, none).count() == 0


def test_statistics_and_densities_of_quality():
    """The statistics against loops over the text, the score against densities from the whole covariance."""
    some = [t for t in texts() if t is None or len(t) < 5000]
    x = quality.statistics(pa.array(some, pa.string()))
    logit = lambda v: np.log((v + 0.002) / (1.002 - v))
    for k, t in enumerate(some):
        b = (t or "").encode()
        w = [v.lower() for v in re.findall(rb"[^\x20\x09-\x0D]+", b)]
        inner, n = max(sum(map(len, w)), 1), max(len(w), 1)
        share = lambda test: logit(sum(map(test, b)) / inner)
        want = [
            np.log1p(len(w)), np.log1p(sum(map(len, w)) / n if w else 1.0), np.log((len(set(w)) + 1) / (len(w) ** 0.85 + 1)), logit(sum(p == q for p, q in zip(w, w[1:])) / n),
            share(lambda c: 65 <= c < 91), share(lambda c: 97 <= c < 123 or c > 127), share(lambda c: 48 <= c < 58), share(lambda c: c in b".,;:'\"()?-"), share(lambda c: c == 33),
            share(lambda c: c < 128 and not chr(c).isalnum() and c not in b" \t\n\x0b\x0c\r.,;:'\"()?-"), logit(sum(c in b" \t\n\x0b\x0c\r" for c in b) / max(len(b), 1)), np.log1p(len(w) / (1 + b.count(b"\n"))),
        ]
        assert np.allclose(x[k], want), t
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    x = rng.normal(0, 1, (300, 3)) + y[:, None]
    m = quality.fit(x, y)
    d, counts = 3, np.bincount(y)
    own = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = (own[0] * counts[0] + own[1] * counts[1]) / 300
    logs = []
    for c in (0, 1):
        s = 0.9 * own[c] + 0.1 * pooled
        s = 0.98 * s + 0.02 * (np.trace(s) / d + 1e-6) * np.eye(d)
        z = x - x[y == c].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) - 0.5 * np.linalg.slogdet(s)[1] + np.log(counts[c] / 300))
    assert np.allclose(m.difference(x), logs[1] - logs[0])


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), "test")
        if name != "best-fit packing":
            assert out.columns == docs.columns
        at[name], docs = (docs, out), out
    before, after = at["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [k for k in labels if labels[k] == 1]
    assert sum(k in kept for k in good) >= 0.95 * len(good)

    before, after = at["n-gram Jaccard join"]
    sets = {r.doc_id: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in before.collect() if (w := re.findall(r"[^\x20\x09-\x0D]+", r.text.lower()))}
    left = {r.doc_id for r in after.collect()}
    ids = sorted(sets)
    group = {k: k for k in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[b], group[a]
                group = {k: new if g == old else g for k, g in group.items()}
    assert left == {min(k for k in ids if group[k] == g) for g in set(group.values())}

    before, after = at["suffix-array dedup"]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    want = {rows[k].doc_id: bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for k, (b, gone) in brute_removed([r.text for r in rows]).items()}
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {k: (t, len(t)) for k, t in want.items()}

    before, after = at["benchmark decontamination"]
    norm = lambda s: " ".join(re.findall(r"\w+", s.lower()))
    items = [norm(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after.collect()}
    assert not any(any(t in norm(r.text) for t in items) for r in after.collect()) and len(left) >= 0.9 * before.count()

    before, after = at["best-fit packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert after.agg({"length": "sum"}).first()[0] == sum(len(packing.token_ids(r.text)) for r in before.collect())
    assert corpus_pipeline.run(spark, sf).count() == after.count()
