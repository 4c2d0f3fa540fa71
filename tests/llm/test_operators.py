"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, copies and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stallmark.llm import decontamination, hash_arrays, kneser_ney, packing, quality, set_join, sharding, suffix_dedup, top_k, toxicity, url_filter
from stallmark.llm.common import connected_components

DOCS = "doc_id long, text string, lang string, held_out int, score double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = "This passage of rather more than fifty bytes stands in several documents, word for word."


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def texts():
    """Nulls, blanks, short and very long texts, copies, edited copies, a shared passage, ties and repeated characters."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeé"), 5)) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words, n))
    base = prose(120).split()
    out = [None, "", " \t\n", "one", "Two words", "two  WORDS", "a b c d", "a b c d e", "A b c d e", "é" * 40, "x" * 300, "x" * 49, "x" * 50, prose(30_000)]
    out += [" ".join(base)] * 3
    for _ in range(6):
        edited = list(base)
        edited[int(rng.integers(0, 120))] = "edited"
        out.append(" ".join(edited))
    out += [prose(40) + " " + PASSAGE + " " + prose(30) for _ in range(4)]
    out += [prose(int(n)) for n in rng.integers(5, 80, 20)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", 1, 0.5) for k, t in enumerate(texts())]
    rows += [(None, "no id at all, but a text", "en", 1, 0.5), (3, "one", "en", 1, 0.5)]  # no id; a repeated row
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def brute_components(all_texts):
    """n_shingles and component of each text, by comparing all pairs."""
    sets = {}
    for k, t in enumerate(all_texts):
        w = WORD.findall(lower(t or ""))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_jaccard_components(docs, empty):
    got = by_id(set_join.jaccard_components(docs))
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == brute_components(texts())
    assert set_join.jaccard_components(docs).count() == docs.count()
    assert set_join.jaccard_components(empty).count() == 0


def test_long_lists_in_blocks(spark, monkeypatch):
    """Families that share a passage: lists that span components, long ones at `longest` = 3, cut into blocks of two or more nodes."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    passage = [word() for _ in range(40)]
    family = []
    for _ in range(6):
        tail = [word() for _ in range(16)]
        for _ in range(7):
            own = list(tail)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = word()
            family.append(" ".join(passage + own + [word() for _ in range(rng.randrange(6))]))
    family += [family[3]] * 3 + [None, ""]
    want = brute_components(family)
    assert 6 < len({c for _, c in want.values()}) < len(family) - 5
    docs = spark.createDataFrame(list(enumerate(family)), "doc_id long, text string").repartition(3)
    for longest, block in ((3, 2), (5, 16)):
        got = by_id(set_join.jaccard_components(docs, longest=longest, block=block))
        assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want, (longest, block)


def test_long_lists_give_the_pairs_of_short_ones(spark):
    rng = np.random.default_rng(3)
    rows = []
    for entry, components in ((-7, 4), (9, 1), (11, 2)):
        for node in rng.permutation(200)[:60] - 100:
            n = int(rng.integers(20, 34))
            rare, main = int(rng.integers(0, 3)), rng.random() < 0.6
            rows.append((entry, int(node), n, rare, int(rng.integers(rare, 7)), int(rng.integers(0, 4)), 1 if main else int(rng.integers(1, components + 1)), int(rng.integers(0, 3)), int(rng.integers(15, n - rare))))
    fields = np.array(rows, np.int64).T
    packed = pa.table([pa.array([fields[0].astype("<i8").tobytes()]), pa.array([fields[1:].tobytes()])], names=["entry", "fields"])
    pairs = lambda t: set(zip(*(t.column(c).to_pylist() for c in "ab")))
    entries = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ("entry", *set_join.FIELDS)))
    stars, crossing = pairs(set_join.star_pairs(packed)), pairs(set_join.cross_pairs(packed))
    assert stars and 100 < len(crossing) < 60 * 59
    assert {tuple(r) for r in set_join.long_star_pairs(entries).collect()} == stars
    for block in (3, 1000):
        assert {tuple(r) for r in set_join.long_cross_pairs(entries, block).collect()} == crossing
    assert set_join.long_cross_pairs(entries.where("entry = 9")).count() == 0


def brute_removed(all_texts, n=50):
    first, out = {}, {}
    data = {k: (t or "").encode() for k, t in enumerate(all_texts)}
    for k, b in data.items():
        for i in range(len(b) - n + 1):
            first.setdefault(b[i : i + n], k)
    for k, b in data.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < k:
                gone[i : i + n] = True
        out[k] = (b, gone)
    return out


def test_repeated_bytes(docs, empty):
    got = by_id(suffix_dedup.repeated_bytes(docs))
    for k, (b, gone) in brute_removed(texts()).items():
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        assert (got[k].n_bytes, got[k].n_removed, got[k].n_spans, got[k].kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), k
    assert suffix_dedup.repeated_bytes(empty).count() == 0
    cut = by_id(suffix_dedup.without_repeats(docs))
    assert PASSAGE in cut[23].text and PASSAGE not in cut[24].text and cut[0].text is None and cut[24].lang == "en"


def test_common_anchors_split(docs):
    """Windows of common anchors, one by one, give the same result."""
    want = sorted(suffix_dedup.repeated_bytes(docs).collect(), key=str)
    split = suffix_dedup.repeats(docs, common=1)
    whole = suffix_dedup.repeats(docs)
    assert sum(len(split.answers.columns(b)["key"]) for b in split.answers.written) > sum(len(whole.answers.columns(b)["key"]) for b in whole.answers.written)
    assert sorted(suffix_dedup.repeated_bytes(docs, common=1).collect(), key=str) == want
    buf = PASSAGE.encode() * 2
    x = suffix_dedup.Suffixes(np.frombuffer(buf, np.uint8), 50)
    assert x.common(np.array([0, 0, 5]), np.array([len(PASSAGE), 1, 5])).tolist() == [50, 0, 50]


def test_runs_of_one_hash_begin_anew(docs, monkeypatch):
    """Two different runs with one key are noticed, within a group and across groups; another seed is tried."""
    content = np.frombuffer(PASSAGE.encode()[:50] + PASSAGE.encode()[1:51], np.uint8)
    ids, windows = np.array([1, 2]), np.array([1, 1])
    clash = lambda group, key: suffix_dedup._answers(np.array(group, np.uint64), np.array(key, np.uint64), ids, ids, windows, content, 50)
    assert clash([7, 7], [9, 9]) is None and clash([7, 8], [9, 9]) is None and clash([7, 7], [9, 10]) is not None
    want = sorted(suffix_dedup.repeated_bytes(docs).collect(), key=str)
    real, asked = suffix_dedup.window_ids, []
    monkeypatch.setattr(suffix_dedup, "window_ids", lambda *a: asked.append(a[-1]) or (None if a[-1] == 0 else real(*a)))
    assert sorted(suffix_dedup.repeated_bytes(docs).collect(), key=str) == want and asked == [0, 1]


def test_suffix_sort_matches_bytes():
    rng = np.random.default_rng(3)
    buf = rng.choice(np.frombuffer(b"ab", np.uint8), 4000)
    place, group = np.arange(3900), np.arange(3900) // 500
    got = suffix_dedup.Suffixes(buf, 50).sort(place, group)
    key = lambda k: (group[k], buf[k : k + 50].tobytes())
    assert [key(k) for k in got] == sorted(key(k) for k in range(3900))


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), rng.normal(0, 1, 8).astype(np.float32).tolist(), "x") for k in range(600)]
    rows[7] = (7, rows[8][1], "x")  # a tie
    rows += [(700, None, "x"), (701, [1.0, None] * 4, "x"), (702, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x"), (800, [0.0] * 8, "x"), (801, [0.5, 0.5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(5)
    v = {k: np.array([math.floor(1024 * float(np.float32(x))) for x in [*e, *[0.0] * (8 - len(e))]], dtype=object) for k, e, _ in rows if k is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    want = {}
    for q in v:
        if q % 100 == 0:
            best = sorted((-int(sum(a * b for a, b in zip(v[q], v[c]))), c) for c in v if c != q)[:10]
            want |= {(q, n): (c, -s) for n, (s, c) in enumerate(best, 1)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k.top_k(df).collect()}
    assert got == want
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k.top_k(df, query_block=2).collect()} == want
    assert top_k.top_k(df.limit(0)).count() == 0
    # Two rows of one id, one better, one worse: both are candidates; an id asked for twice is two queries that do not meet themselves.
    twice = spark.createDataFrame([(5, [1.0, 0.0]), (5, [2.0, 0.0]), (100, [1.0, 0.0]), (100, [3.0, 0.0]), (7, [0.5, 9.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score >> 20) for r in top_k.top_k(twice).collect())
    assert got == sorted([(100, 1, 100, 3), (100, 2, 5, 2), (100, 3, 5, 1), (100, 4, 7, 0), (100, 1, 5, 6), (100, 2, 5, 3), (100, 3, 100, 3), (100, 4, 7, 1)])
    assert top_k.exact_products(np.array([[2.0**40] * 2]), np.array([[2.0**40] * 2]))[0] == 2**63 - 1


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for x in [*[x for x in texts() if x], "a <|endoftext|> b", "naïve 東京 \u00a0 😀\r\n\n  x's 12,3"]:
        assert packing.token_ids(x).tolist() == [*t.encode(x, add_special_tokens=False).ids, 0]
    rows = packing.best_fit(docs).collect()
    own, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    for k, text in enumerate(texts()):
        ids = packing.token_ids(text)
        if k == 3:
            continue  # the repeated row
        parts = sorted(own[k], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1]) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == 2048 for r in parts[1:]) and all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].astype("<u4").tobytes()) for r in parts)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 2048) + 2
    assert packing.best_fit(empty).count() == 0
    bounded = packing.OpenBins(10, 1)
    assert [bounded.put(n)[0] for n in (6, 5, 4, 5)] == [0, 1, 1, 2]  # bin 0, the fuller, closed when bin 1 opened


def test_tokens_of_a_long_run_of_spaces():
    """The pattern of the ranks gives up on this text; the ids are those of the tokenizers file all the same."""
    import public_tokenizers
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("Some words" + " " * 999_990 + "and more", "Some words<|endoftext|>" + " " * 1_000_010 + "and more"):
        assert packing.token_ids(text).tolist() == [*file.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_sharding(docs, empty):
    rows = sharding.reshard(docs).collect()
    assert len(rows) == docs.count()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None} == {(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in enumerate(texts())}
    assert sharding.reshard(empty).count() == 0
    flow = sharding.min_cost_flow([10, 0, 2], [4, 4, 4], lambda i, j: 0 if i == j else 1)
    assert sum(v for (i, j), v in flow.items() if i != j) == 6 and sum(flow.values()) == 12


def test_shards_are_even(spark, sf):
    d = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    out = sharding.reshard(d)
    by = [r.b for r in out.groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()]
    longest = out.agg({"size": "max"}).first()[0]
    assert len(by) == 16 and max(by) - min(by) <= 2 * longest
    path = sharding.rewrite_affected(d, out)
    assert spark.read.parquet(path).count() == d.count()


def test_rows_without_ids_and_copies_are_sharded_and_written_once(spark, tmp_path):
    """A third of the rows without an id, a third of one id: no block holds them all, and each is written once beside a clashing column."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, "same" if k % 3 == 1 else f"text {k}", k) for k in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(5).write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    out = sharding.reshard(d, 3, 4)
    size = {r.shard: r.b for r in out.groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()}
    assert len(size) == 4 and max(size.values()) - min(size.values()) <= 40 and out.select("shard", "slot").distinct().count() == 3000
    written = spark.read.parquet(sharding.rewrite_affected(d, out))
    affected = {r.shard for r in out.where("shard <> old_shard").collect()} | {r.old_shard for r in out.where("shard <> old_shard").collect()}
    assert sorted(r["shard"] for r in written.select("shard").collect()) == sorted(k for r, (_, _, k) in zip(out.orderBy("row").collect(), [(0, 0, x.shard) for x in d.collect()]) if r.shard in affected)


def test_flow_moves_the_fewest_bytes():
    """Against every flow of small supplies, for general costs and for moved bytes."""
    rng = np.random.default_rng(6)

    def least(supply, demand, cost):
        if not supply:
            return 0
        best = math.inf
        for part in itertools.product(*(range(min(supply[0], d) + 1) for d in demand)):
            if sum(part) == supply[0]:
                best = min(best, sum(x * c for x, c in zip(part, cost[0])) + least(supply[1:], [d - x for d, x in zip(demand, part)], cost[1:]))
        return best

    for _ in range(25):
        n, m = int(rng.integers(1, 4)), int(rng.integers(1, 4))
        supply = [int(x) for x in rng.integers(0, 6, n)]
        demand = sharding.even(sum(supply), m)
        for cost in ([[int(i != j) for j in range(m)] for i in range(n)], rng.integers(0, 9, (n, m)).tolist()):
            flow = sharding.min_cost_flow(supply, demand, lambda i, j, c=cost: c[i][j])
            assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(n)] == supply and [sum(v for (_, j), v in flow.items() if j == k) for k in range(m)] == demand
            assert sum(v * cost[i][j] for (i, j), v in flow.items()) == least(supply, demand, cost)


def test_url_filter(spark):
    rows = [
        (1, "HTTP://WWW.Example.com/en/x?q=1", "h"), (2, "https://blog.example.com/en/", "h"), (3, "https://blog.example.com/de/", "h"), (4, "http://a.net/es/1#f", "h"), (5, "http://a.net/en/1", "h"),
        (6, None, "h"), (7, "no scheme", "h"), (8, "x://host?q=/en/", "h"), (9, "http://badexample.com/en/", "h"), (9, "http://badexample.com/en/", "h"), (None, "http://b.org/", "h"), (11, "://net/fr/", "h"),
    ]
    got = {r.page_id: r for r in url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()}
    assert [got[k].rule for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11)] == ["www.example.com/en/", "example.com/en/", "com/", "net/es/", None, None, None, None, "com/", "net/fr/"]
    assert (got[1].host, got[1].path, got[1].verdict) == ("www.example.com", "/en/x", "allow") and (got[8].host, got[8].path) == ("host", "") and got[2].verdict == "block"
    assert all(r.verdict in ("allow", "block") for r in got.values()) and (got[6].host, got[6].path) == ("", "")
    assert url_filter.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0
    # As many allowed as blocked outcomes: a host without any keeps the overall share, which is not above the threshold.
    many = [(k, f"http://bad.net/fr/{k}") for k in range(40)] + [(k, f"http://good.com/{k}") for k in range(40, 80)] + [(100, "http://bad.net/"), (101, "http://other.org/")]
    got = {r.page_id: r.verdict for r in url_filter.url_filter(spark.createDataFrame(many, "page_id long, url string")).collect()}
    assert got[100] == "block" and got[101] == "allow"


ITEM = "A train leaves the old station with 120 passengers and Peter counts 45 km before Peter reaches the next town on the river"


def test_decontamination(spark):
    changed = ITEM.replace("120", "300").replace("45", "7").replace("Peter", "Maria")
    unfit = changed.replace("Maria reaches", "Anna reaches")  # one name for two: not the same question
    rows = [
        (1, f"Before it. {ITEM} and after."), (2, f"Other words here, {changed}. The end."), (3, f"Some words, {unfit}."), (4, None), (5, ""), (6, "nothing of the kind at all, only clean prose of some length about birds"),
        (None, ITEM), (7, ITEM.lower()), (8, "word " * 20_000 + ITEM), (1, f"Before it. {ITEM} and after."),
    ]
    bench = spark.createDataFrame([(10, ITEM), (10, ITEM), (11, None), (12, ""), (13, "too short")], "item_id long, text string")
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, item_id string")
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated(docs, bench).collect()}
    assert set(got) == {1, 2, 7, 8} and got[2] == [10]
    assert decontamination.decontaminated(docs, bench).count() == 5  # of 10 rows, those of ids 1 (twice), 2, 7 and 8 go
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0 and decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_of_items_full_of_numbers(spark):
    """Items without a window of enough ordinary tokens: copies and changed numbers are found, other questions are not."""
    system, short, bare = "Solve 3 x + 4 y = 10 and 5 x - 2 y = 7", "Tom has 3 apples", "3 4 5 6 7 8 9 10 11"
    rows = [
        (1, f"Before it. {system} and more"), (2, f"Before it. {system.translate(str.maketrans('3457', '6891'))} and more"), (3, f"Some text. {short}."), (4, "Some text. Tom has 5 apples."),
        (5, f"row {bare} row"), (6, "row 13 14 15 16 17 18 19 20 21 row"), (7, "Solve 3 x + 4 y = 10 or 5 x - 2 y = 7"), (8, "Some text. Tom has 5 pears."), (9, "Before it. Solve 6 x + 6 y = 10 and 5 x - 2 y = 7"),
    ]
    bench = spark.createDataFrame([(20, system), (21, short), (22, bare)], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: [20], 2: [20], 3: [21], 4: [21], 5: [22]}


QUESTIONS = (
    ("In the old market Peter buys 5 apples and 5 pears for his sister and then walks home along the quiet river", "In the old market Anna Lopez buys 7 apples and 4 pears for his sister and then walks home along the quiet river"),
    ("The small garden has 3 rows of 4 trees and 5 rows of 6 bushes, how many plants does the gardener water each day", "The small garden has 9 rows of 9 trees and 9 rows of 2 bushes, how many plants does the gardener water each day"),
    ("On the long road Maria Silva drives 120 km before the bridge and rests for 2 hours near the green hotel", "On the long road Tom drives 80 miles before the bridge and rests for 3 hours near the green hotel"),
    ("At the busy station Ivan counts 45 trains and Olga counts 30 buses until the clock strikes and both go home", "At the busy station Juan Carlos counts 12 trains and Eva counts 12 buses until the clock strikes and both go home"),
    ("Im alten Haus zählt Peter 14 Fenster und 3 Türen bevor er mit dem Zug nach Hause fährt und dort schläft", "Im alten Haus zählt Frau Schmidt 20 Fenster und 9 Türen bevor er mit dem Zug nach Hause fährt und dort schläft"),
    ("A tank holds 200 liters of clear water and loses 4 liters every minute through a crack in the thin wall", "A tank holds 350 gallons of clear water and loses 7 gallons every minute through a crack in the thin wall"),
    ("The baker sells 60 loaves in the morning and 25 in the evening, so how many loaves are sold in one week", "The baker sells 33 loaves in the morning and 11 in the evening, so how many loaves are sold in one week"),
    ("When the ship leaves the harbour Captain Brown sees 7 gulls and 2 whales far away behind the white tower", "When the ship leaves the harbour Lee sees 5 gulls and 5 whales far away behind the white tower"),
)


def test_decontamination_of_changed_questions(spark):
    """Numbers, names of one word or more, and units changed, in two languages: at least nine in ten are found, nothing else is."""
    rng = np.random.default_rng(4)
    words = " ".join(q for q, _ in QUESTIONS).lower().split()
    clean = [(1000 + k, " ".join(rng.choice(words, 60)) + f" {k} km.") for k in range(40)]
    rows = [(k, f"Some words before. {q}. And after.") for k, (q, _) in enumerate(QUESTIONS)] + [(100 + k, f"Some words before. {q}. And after.") for k, (_, q) in enumerate(QUESTIONS)]
    bench = spark.createDataFrame([(k, q) for k, (q, _) in enumerate(QUESTIONS)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(spark.createDataFrame(rows + clean, "doc_id long, text string"), bench).collect()}
    assert {(k, k) for k in range(len(QUESTIONS))} <= got
    assert sum((100 + k, k) in got for k in range(len(QUESTIONS))) >= 0.9 * len(QUESTIONS)
    assert all(doc % 100 == item for doc, item in got)


def test_decontamination_of_short_items(spark):
    """Items of one to nine tokens are all looked for in one pass over the documents."""
    items = [" ".join(["alpha", "bravo", "carbon", "delta", "echoes", "foxes", "golfer", "hotels", "island"][:n]) for n in range(1, 10)]
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    docs = spark.createDataFrame([(k, f"some {x} words") for k, x in enumerate(items, 1)], "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {k: list(range(1, k + 1)) for k in range(1, 10)}


def test_decontamination_of_other_scripts(spark):
    """Names that begin outside A-Z, words joined by punctuation and other spaces than U+0020."""
    item = "In the old harbour Émile and Öznur count 120 km of rope before Иван carries the well-known barrels, then they rest"
    changed = item.replace("Émile", "Zoë").replace("Öznur", "Åsa").replace("Иван", "Пётр").replace("120", "300")
    joined = item.replace("120 km", "120\u00a0km").replace("well-known", "well known").replace("barrels, then", "barrels,then").replace(" the ", "\u2009the\u3000").replace("old harbour", "old/harbour")
    rows = [(1, f"Before it. {item}."), (2, f"Before it. {changed}."), (3, f"Before it. {joined}."), (4, f"Before it. {changed.replace('Åsa', 'Zoë')}.")]
    bench = spark.createDataFrame([(30, item)], "item_id long, text string")
    got = {r.doc_id for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1, 2, 3}


def test_decontamination_finds_planted_passages(spark, sf):
    d, b = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    norm = lambda s: " ".join(re.findall(r"\w+", (s or "").lower()))
    items = {r.item_id: norm(r.text) for r in b.collect()}
    runs = {k: [" ".join(t.split()[i : i + 13]) for i in range(len(t.split()) - 12)] for k, t in items.items()}
    want = set()
    for r in d.collect():
        text = norm(r.text)
        want |= {(r.doc_id, k) for k, own in runs.items() if any(x in text for x in own)}
    assert {(r.doc_id, r.item_id) for r in decontamination.matches(d, b).collect()} == want


def brute_kneser_ney(train, score):
    """The same model in dictionaries."""
    sent = [[*WORD.findall(lower(t or "")), "</s>"] for t in train]
    pairs = Counter(p for s in sent for p in zip(["<s>", *s], s))
    count = Counter(w for s in sent for w in s)
    cont = Counter(w for _, w in pairs)
    total = defaultdict(int)
    kinds = defaultdict(lambda: [0, 0, 0])
    for (h, _), c in pairs.items():
        total[h] += c
        kinds[h][min(c, 3) - 1] += 1
    disc = lambda values: kneser_ney.discounts([sum(v == k for v in values) for k in (1, 2, 3, 4)])
    d, dw, n, t = disc(pairs.values()), disc(cont.values()), sum(count.values()), sum(cont.values())
    spread = sum(dw[min(c, 3) - 1] for c in cont.values()) / t
    uni = lambda w: (max(cont[w] - dw[min(cont[w], 3) - 1], 0) / t if cont[w] else 0) + spread / (len(count) + 1)

    def p(h, w):
        c = pairs[h, w]
        back = sum(a * b for a, b in zip(d, kinds[h])) / total[h] if total[h] else 1.0
        return (max(c - d[min(c, 3) - 1], 0) / total[h] if c else 0) + back * uni(w)

    out = []
    for text in score:
        s = [*WORD.findall(lower(text or "")), "</s>"]
        out.append((len(s), sum(count[w] > 0 for w in s), sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in s), sum(math.log10(p(h, w)) for h, w in zip(["<s>", *s], s))))
    words = [*count, "never seen"]
    assert abs(sum(p("<s>", w) for w in words) - 1) < 1e-9 and abs(sum(p(words[0], w) for w in words) - 1) < 1e-9
    return n, out


def test_kneser_ney(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fold = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7
    n, want = brute_kneser_ney([t for k, t in rows if fold(k) != 2], [t for _, t in rows])
    got = by_id(kneser_ney.perplexities(docs))
    for (k, _), (tokens, known, base, score) in zip(rows, want):
        if k is not None:
            r = got[k]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, fold(k) == 2)
            assert abs(r.base_score - base) < 1e-6 * abs(base) and abs(r.score - score) < 1e-6 * abs(score)
    assert kneser_ney.perplexities(empty).count() == 0
    nothing = kneser_ney.train(empty)
    assert {r.score for r in kneser_ney.score(docs, nothing).collect()} == {0.0}


def brute_kneser_ney_of_order(order, train, score):
    """The model of any order in dictionaries: continuation counts below the top, but own counts after a document's start."""
    sent = [[*["<s>"] * (order - 1), *WORD.findall(lower(t or "")), "</s>"] for t in train]
    count = {order: Counter(tuple(s[i : i + order]) for s in sent for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        count[k] = Counter()
        for g, c in count[k + 1].items():
            count[k][g[1:]] += c if g[1:][0] == "<s>" else 1
    d = {k: kneser_ney.discounts([sum(c == n for c in count[k].values()) for n in (1, 2, 3, 4)]) for k in count}
    follow = {}
    for k in range(2, order + 1):
        for g, c in count[k].items():
            own = follow.setdefault(g[:-1], [0, 0, 0, 0])
            own[0] += c
            own[min(c, 3)] += 1
    t, words = sum(count[1].values()), {g[0] for g in count[1]}
    spread = sum(d[1][min(c, 3) - 1] for c in count[1].values()) / t
    less = lambda c, k: max(c - d[k][min(c, 3) - 1], 0) if c else 0

    def p(g):
        if len(g) == 1:
            return less(count[1][g], 1) / t + spread / (len(words) + 1)
        total, *n = follow.get(g[:-1], (0, 0, 0, 0))
        back = sum(a * b for a, b in zip(d[len(g)], n)) / total if total else 1.0
        return (less(count[len(g)][g], len(g)) / total if total else 0) + back * p(g[1:])

    some = sent[0][: order - 1]
    assert abs(sum(p((*some, w)) for w in [*words, "never seen"]) - 1) < 1e-9
    out = []
    for text in score:
        s = [*["<s>"] * (order - 1), *WORD.findall(lower(text or "")), "</s>"]
        out.append(sum(math.log10(p(tuple(s[i : i + order]))) for i in range(len(s) - order + 1)))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_of_order(docs, order):
    """Against dictionaries, also where pairs with frequent words are dealt by both words (many small buckets)."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fold = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7
    want = brute_kneser_ney_of_order(order, [t for k, t in rows if fold(k) != 2], [t for _, t in rows])
    model = kneser_ney.train(docs.where("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"), order, bucket_bytes=100)
    assert model.frequent > 1 and model.words.arrays.buckets > 50
    got = by_id(kneser_ney.score(docs, model))
    for (k, _), score in zip(rows, want):
        if k is not None:
            assert abs(got[k].score - score) < 1e-6 * abs(score), k


def test_words_of_one_hash_begin_anew(docs, monkeypatch):
    """A first seed under which all words clash is given up; the next gives the counts."""
    told = kneser_ney._counted_words(docs, 16, 0)
    real, asked = kneser_ney._counted_words, []
    monkeypatch.setattr(kneser_ney, "_counted_words", lambda d, b, seed: asked.append(seed) or (None if seed == 0 else real(d, b, seed)))
    again = kneser_ney.vocabulary(docs, 16)
    assert asked == [0, 1] and again.seed == 1 and (again.size, again.tokens) == (told.size, told.tokens)
    w, c, n = kneser_ney.merged_words(np.array([5, 5, 5], np.uint64), np.array([1, 2, 1], np.uint32), np.array([1, 1, 1]))
    assert w.tolist() == [5, 5] and c.tolist() == [1, 2] and n.tolist() == [2, 1]


def test_tables_of_keys():
    """Keys that agree in their leading bits, keys that are not there, empty tables."""
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 63, 5000, dtype=np.uint64), (np.uint64(7) << np.uint64(40)) | (np.arange(300, dtype=np.uint64) << np.uint64(18))]))
    own = hash_arrays.key_columns(keys, "k")
    assert (hash_arrays.find(own, "k", keys) == np.arange(len(keys))).all()
    assert (hash_arrays.find(own, "k", keys ^ np.uint64(1 << 45)) < 0).mean() > 0.99
    none = hash_arrays.key_columns(np.zeros(0, np.uint64), "k")
    assert (hash_arrays.find(none, "k", keys) < 0).all()


def test_missing_bucket_is_an_error(tmp_path):
    """A written bucket that a task cannot find raises; one that was never written is empty."""
    hash_arrays.save(str(tmp_path), "3", key=np.array([1, 5], np.uint64), count=np.array([7, 8], np.uint8))
    got = hash_arrays.Arrays(str(tmp_path), 8, [3]).lookup(np.array([1, 2, 5], np.uint64), np.array([3, 3, 3]), ("count",))
    assert got[0].tolist() == [True, False, True] and got[1].tolist() == [7, 0, 8]
    assert hash_arrays.Arrays(str(tmp_path), 8, []).columns(3) == {}
    with pytest.raises(FileNotFoundError):
        hash_arrays.Arrays(str(tmp_path), 8, [3, 4]).columns(4)


def test_bucket_sets():
    numbers = [0, 1, 7, 8, 4095, 32_768, 99_999]
    own = hash_arrays.Buckets(numbers)
    assert list(own) == numbers and 7 in own and 6 not in own and 100_000 not in own and 10**9 not in own and -1 not in own
    assert list(hash_arrays.Buckets()) == [] and 0 not in hash_arrays.Buckets()


def test_many_buckets_reach_the_driver_as_bits(spark):
    """Of 100,000 buckets, 13 bytes for each hundred and one row for 32,768 reach the driver; a task holds a bucket at a time."""
    import pickle

    rows = spark.range(300_000).select((F.pmod(F.xxhash64("id"), F.lit(50_000)) * 2).cast("int").alias("bucket"), "id").repartition(5)

    def merge(got):
        assert len(set(got.column("bucket").to_pylist())) == 1
        return pa.table({"n": [got.column("bucket")[0].as_py()], "rows": [got.num_rows], "least": [min(got.column("id").to_pylist())]})

    merged = hash_arrays.by_bucket(rows, 100_000, merge, "n long, rows long, least long", most_tasks=6)
    assert merged.rdd.getNumPartitions() == 6
    done, sums = hash_arrays.told(merged, rows=F.col("rows"), least=F.col("least"))
    want = rows.groupBy("bucket").agg(F.min("id").alias("least")).toPandas()
    assert list(done) == sorted(want.bucket) and sums == {"rows": 300_000, "least": want.least.sum()}
    assert len(pickle.dumps(hash_arrays.Arrays("/none", 100_000, done))) < 20_000
    none, sums = hash_arrays.told(merged.where("n < 0").union(spark.createDataFrame([(None, 3, 4)], "n long, rows long, least long")), rows=F.col("rows"))
    assert list(none) == [] and sums == {"rows": 3}
    assert hash_arrays.told(merged.where("n < 0"), rows=F.col("rows"))[1] == {"rows": 0}


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_word_numbers_whatever_the_blocks(spark, monkeypatch, block):
    """Each word has its own number from 1 on, the more frequent powers of two first, then by bucket and hash."""
    texts = [" ".join(f"w{k}" for k in range(1, 200) if n % k == 0) for n in range(1, 60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(kneser_ney, "BASE_BLOCK", block)
    words = kneser_ney.vocabulary(docs, 17)
    (_, hashes, checks, places, _), = kneser_ney.tokens(pa.array(texts), words.seed)
    number, count = words.numbers(hashes, checks)
    assert (count == np.bincount(places, minlength=len(hashes))).all() and words.size == len(hashes) and words.tokens == count.sum()
    order = sorted(range(len(hashes)), key=lambda k: (-int(np.log2(count[k])), int(hashes[k])))
    assert [int(number[k]) for k in order] == list(range(1, len(hashes) + 1))
    assert words.numbers(hashes + np.uint64(1), checks)[0].tolist() == [kneser_ney.UNKNOWN] * len(hashes)


def labelled(spark, sf, label, operator):
    big = sf.replace("0.001", "0.01")
    d, l = (spark.read.parquet(f"{big}/{n}.parquet") for n in ("documents", "labels"))
    out = operator(d, l)
    assert out.count() == d.count()
    rows = out.join(l, "doc_id").where("held_out").collect()
    return [(r.score, r.predicted, r[label]) for r in rows]


def auc(rows):
    pos, neg = [s for s, _, y in rows if y], [s for s, _, y in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize(("label", "operator", "least"), [("toxic", toxicity.toxicity, 0.75), ("quality", quality.quality, 0.95)])
def test_classifiers(spark, sf, docs, empty, label, operator, least):
    rows = labelled(spark, sf, label, operator)
    assert auc(rows) >= least and all(0 <= s <= 1 for s, _, _ in rows)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)] + [(None, 1, 1), (2, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert operator(docs, labels).count() == docs.count()
    assert operator(empty, labels).count() == 0
    same = {r.score for r in operator(docs, labels.where("quality = 1")).collect()}
    assert len(same) == 1 and 0.5 < same.pop() <= 1
    assert operator(docs, labels.limit(0)).select("score").distinct().collect()[0].score == pytest.approx(0.5)


def test_machine_learns_pairs():
    """A pair of terms that is toxic only together: additive weights cannot separate it."""
    places, y = [], []
    for k in range(400):
        a, b = k % 2, k // 2 % 2
        places.append(np.array([0] * a + [1] * b))
        y.append(int(a == b == 1) or int(a == b == 0))
    m = toxicity.fit(places, np.array(y), np.array([5, 9]), epochs=60)
    p = m.raw([[], [0], [1], [0, 1]])
    assert p[0] > 0 > p[1] and p[3] > 0 > p[2]


def test_toxicity_of_pairs(spark):
    """Through train() and score(): two words that are neutral alone and say all together, among other words."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("bcdfghjklm"), 7)) for _ in range(300)]
    rows, labels = [], []
    for k in range(4000):
        a, b = k % 2, k // 2 % 2
        rows.append((k, " ".join([*rng.choice(words, 15), *["zebras"] * a, *["quorum"] * b])))
        labels.append((k, int(a == b)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 102), (102, 100), (200, 200)] + [(300, k) for k in range(301, 340)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[102] == 100 and got[339] == 300 and 200 not in got
