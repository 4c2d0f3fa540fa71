"""Merkle manifest, chat formatting and cross-tokenizer alignment against brute-force versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stallmark.llm import alignment, chat, decontamination, merkle, packing, sharding
from stallmark.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, root string, grp int"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


# Merkle manifest


def rows_of_sources():
    rng = np.random.default_rng(3)
    out = []
    for source, n in (("hot", 700), ("é", 17), ("a", 16), ("one", 1), (None, 40), ("z" * 3, 257), ("", 2)):
        for k in range(n):
            text = [None, "", "A b C", "É" * int(rng.integers(1, 50)), "Long Words " * int(rng.integers(1, 300))][int(rng.integers(0, 5))]
            out.append((int(rng.integers(-(10**6), 10**6)), text, None if k % 7 == 0 else "en", source, None if k % 5 == 0 else k, "extra", 1))
    out += [out[0]] * 3 + [(None, "no id", "en", "hot", 1, "x", 2)] * 2
    out += [(5, t, "en", "many", 1, "x", 1) for t in "abcdefghijklmnopqrst"]
    out += [(k, f"source {k}", "en", f"s{k:03d}", 1, "x", 1) for k in range(40)]
    return out


def brute_leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The root, and the siblings before and after of every node, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            lo = p // 16 * 16
            paths[k].append(("".join(nodes[lo:p]), "".join(nodes[p + 1 : lo + 16])))
        at = [p // 16 for p in at]
        nodes = [h("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[b"" if r[3] is None else b"s" + r[3].encode()].append(r)
    keys = sorted(by)
    for k in keys:
        by[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
    trees = {k: climb([brute_leaf(r) for r in by[k]]) for k in keys}
    root, tops = climb([trees[k][0] for k in keys])
    out = []
    for k, top in zip(keys, tops):
        for r, path in zip(by[k], trees[k][1]):
            leaf = at = brute_leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                at = brute_leaf(r, True)
            for b, a in path + top:
                at = h(b + at + a)
            out.append((r[0], leaf, trees[k][0], root, h("".join(b + a for b, a in path + top)), at, at == root))
    return Counter(out)


def test_manifest(spark):
    rows = rows_of_sources()
    got = merkle.verified(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert Counter(tuple(r) for r in got) == brute_manifest(rows)


def test_manifest_with_several_rounds(spark, monkeypatch):
    """Blocks of 16 leaves and rounds of 16 nodes: as many rounds as 10**12 rows have with the usual ones."""
    rows = [(k, f"Text {k}", "en", "hot", k, "x", 1) for k in range(5000)] + [(k, "t", "en", f"s{k}", k, "x", 1) for k in range(300)]
    monkeypatch.setattr(merkle, "BLOCK", 16)
    monkeypatch.setattr(merkle, "UPPER", 16)
    got = merkle.verified(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == brute_manifest(rows)


def test_append_keeps_whole_blocks(spark):
    rows = [(k, f"Text {k}", "en", "hot" if k % 4 else "cold", k, "x", 1) for k in range(3000)]
    first, second = rows[:2000], rows[2000:] + [(9, "new", "en", "new", 1, "x", 1)]
    before = merkle.manifest(spark.createDataFrame(first, DOCS))
    after = merkle.append(before, spark.createDataFrame(second, DOCS).repartition(4))
    whole = {(bytes(r.grp), r.block): r.root for r in before.where(F.col("n") == merkle.BLOCK).collect()}
    now = {(bytes(r.grp), r.block): r.root for r in after.collect()}
    assert len(whole) >= 6 and whole.items() <= now.items()
    got = {(r.doc_id, r.leaf): r for r in merkle.witnesses(after).collect()}
    want = brute_manifest(rows[:2000] + second)
    assert {(r.doc_id, r.leaf, r.subroot, r.root) for r in got.values()} == {w[:4] for w in want}
    assert all(merkle.folded(r.leaf, [(s.before, s.after) for s in r.proof]) == r.root for r in got.values())
    with pytest.raises(ValueError, match="precede"):
        merkle.append(after, spark.createDataFrame(first[:5], DOCS))


def test_witness_grows_with_later_siblings():
    tree = merkle.Subtree(2)
    first = tree.append("a")
    assert list(tree.witness(first)) == [("", "")]
    tree.append("b")
    assert list(tree.witness(first)) == [("", "b")]
    for c in "cdefghijklmnopq":
        tree.append(c)
    level0, level1 = tree.witness(first)
    assert level0 == ("", "bcdefghijklmnop") and level1 == ("", "")  # the second run is open yet
    root = tree.close()
    assert merkle.folded("a", list(tree.witness(first))) == root


def test_manifest_empty(spark):
    assert merkle.verified(spark.createDataFrame([], DOCS)).count() == 0


# Chat formatting

TURNS = "conv_id long, turn long, role string, text string, example int, is_last string"


def conversations():
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<\\s>", "[", "<", "</", " [/INST]\n", "</s>\n<s>[INST] user", "[\\INST]", "$1 \\2", "<<s>>[[INST]]", "é😀", "\n", " ", "", None]
    rows = [(1, k, ("user", "assistant")[k % 2], t, 0, "x") for k, t in enumerate(nasty)]
    rows += [(2, 0, "system", "be brief", 0, "x"), (2, 1, "user", "hi", 0, "x")]  # no target
    rows += [(3, 0, "assistant", "alone", 0, "x"), (4, 0, "user", "q", 0, "x"), (4, 1, "assistant", "", 0, "x"), (4, 2, "user", "tail", 0, "x")]
    rows += [(5, None, "user", "no number", 0, "x"), (5, 0, "assistant", "a", 0, "x"), (5, 0, "assistant", "a", 0, "x"), (5, 0, None, "no role", 0, "x")]
    rows += [(None, 0, "user", "no conversation", 0, "x"), (None, 1, "assistant", "yes", 0, "x")]
    rows += [(6, 0, "[/INST]\n</s>", "odd role", 0, "x"), (7, 0, "user", "w " * 200_000, 0, "x"), (7, 1, "assistant", "<s>" * 50_000, 0, "x")]
    rows += [(8, k, ("user", "assistant")[k % 2], f"turn {k}", 0, "x") for k in range(300)]
    return rows


def test_chat_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    turns = defaultdict(list)
    for c, n, role, text, *_ in rows + [(-7, 0, "user", chat.EXTRA_TEXT), (-7, 1, "assistant", chat.EXTRA_TEXT)]:
        turns[c].append((n is not None, n or 0, role or "", text or ""))
    got = {r.conv_id: r for r in chat.chat_formatting(df).collect()}
    assert set(got) == set(turns)
    for c, own in turns.items():
        own.sort()
        trained = [t for *_, role, t in own if role == "assistant"]
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(own), h("".join(f"{role}\n{t}\n" for *_, role, t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len("".join(trained)), h("".join(trained)))
        assert r.n_examples == len(trained) + (own[-1][2] != "assistant")


def test_chat_examples(spark):
    found = defaultdict(list)
    for r in chat.examples(spark.createDataFrame(conversations(), TURNS)).orderBy("conv_id", "example").collect():
        found[r.conv_id].append(r)
    assert found[4][0].text == "<s>[INST] user [/INST]\nq</s>\n<s>[INST] assistant [/INST]\n</s>\n"
    assert found[4][1].text == found[4][0].text + "<s>[INST] user [/INST]\ntail</s>\n" and found[4][1].loss_length == 0
    for own in found.values():
        assert [r.example for r in own] == list(range(len(own)))
        for a, b in zip(own, own[1:]):
            assert b.text.startswith(a.text)  # all preceding turns are context
        for r in own:
            if r.loss_length:
                end = r.loss_start - 1 + r.loss_length
                assert r.text[end:] == chat.TEMPLATE.close and r.text[: r.loss_start - 1].endswith("assistant" + chat.TEMPLATE.middle)


def test_chat_empty_and_native(spark):
    empty = chat.chat_formatting(spark.createDataFrame([], TURNS))
    assert [r.conv_id for r in empty.collect()] == [-7]
    plan = empty._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Cross-tokenizer alignment

TEXTS = [
    "a\n  b \t c  ", "<|endoftext|> x", "x▁y z", "<s> </s> <unk>", None, "", " lead", "\x1c !\x1c x", "é   b　c d", "ﬁ ① x", "a" * 5000, " " * 300,
    "日本語 テキスト 日本", "😀👍 x 😀", "tab\tend \n", "ab" * 3000, "The cat sat on the mat, said Dr. O'Neil (aged 41).", "the the the cat",
]


def brute_groups(text, a, b):
    """The groups (A ids, B ids) of a text, by sets of ends; none where its bytes do not come back."""
    if not text:
        return []
    of = alignment.pair_of()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba, bb = [of.a.decode_single_token_bytes(k) for k in ia], [of._piece(k) for k in ib]
    if not b"".join(ba) == (" " + text).encode() == b"".join(bb):
        return []
    ea, eb = np.cumsum([*map(len, ba)]).tolist(), np.cumsum([*map(len, bb)]).tolist()
    both, out, i, j = sorted(set(ea) & set(eb)), [], 0, 0
    for end in both:
        p, q = ea.index(end, i) + 1, eb.index(end, j) + 1
        out.append((ia[i:p], ib[j:q]))
        i, j = p, q
    return out


def test_alignment(spark, sf):
    given = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts = TEXTS + given + given[:2]
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    groups = [brute_groups(t, a, alignment.pair_of().b) for t in texts]
    links = [Counter((p, q) for ga, gb in g for p in ga for q in gb) for g in groups]
    held = Counter(k for c in links for k in c)
    most = defaultdict(int)
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, pairs string").repartition(5)
    got = {r.doc_id: r for r in alignment.cross_alignment(docs).collect()}
    assert len(got) == len(texts)
    for k, (g, c) in enumerate(zip(groups, links)):
        r = got[k]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        assert (r.n_a, r.n_b, r.n_groups) == (sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g))
        assert r.groups_sha256 == (h(text) if text else "")
        assert r.n_links == sum(c.values()) and r.count_sum == sum(n * held[x] for x, n in c.items())
        assert r.n_best == sum(n for x, n in c.items() if held[x] == most[x[0]])
    assert got[2].n_a == 0 and got[9].n_groups > 0


@pytest.mark.parametrize("seed", range(30))
def test_run_skipping(seed):
    """Random end arrays with long one-to-one stretches, shifts and wide groups; lanes of any size."""
    rng = np.random.default_rng(seed)
    both = np.cumsum(rng.integers(1, 5, int(rng.integers(1, 400))))
    ea, eb = (np.unique(np.append(rng.choice(both, int(len(both) * rng.uniform(0.3, 1)), replace=False), both[-1])) for _ in range(2))
    common, want, i, j = np.intersect1d(ea, eb), [], 0, 0
    for end in common:
        p, q = int(np.searchsorted(ea, end)), int(np.searchsorted(eb, end))
        if p > i or q > j:
            want.append((i, p, j, q))
        i, j = p + 1, q + 1
    for size in (1, 7, 64, 10_000):
        assert [tuple(x) for x in alignment.irregular(ea, eb, size).tolist()] == want


def test_wide_groups_count_by_distinct_ids(monkeypatch):
    of = alignment.pair_of()
    texts = ["ab" * 300, "日本語 テキスト", "plain words here"]
    plain = alignment.Alignment(*of.encoded(texts), of).links()
    monkeypatch.setattr(alignment, "WIDE", 0)
    wide = alignment.Alignment(*of.encoded(texts), of).links()
    for (k1, c1), (k2, c2) in zip(plain, wide):
        assert (k1 == k2).all() and (c1 == c2).all()


def test_alignment_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.cross_alignment(docs).count() == 0
    nothing = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert {(r.doc_id, r.n_a, r.count_sum, r.groups_sha256) for r in alignment.cross_alignment(nothing).collect()} == {(None, 0, 0, ""), (1, 0, 0, "")}
    assert alignment.vocabulary_map(spark.createDataFrame([(1, "the cat"), (2, "the dog")], "doc_id long, text string")).count() >= 3


# Letter case, and rows that keep their identity


def test_decontamination_of_other_letter_case(spark):
    """Copies as written are found in lower, upper and title case, and nothing else is."""
    from .test_operators import QUESTIONS

    items = [q for q, _ in QUESTIONS]
    cases = (str, str.lower, str.upper, str.title)
    rows = [(100 * c + k, f"Some words before. {f(q)}. And after.") for c, f in enumerate(cases) for k, q in enumerate(items)]
    rng = np.random.default_rng(4)
    words = " ".join(items).split()
    rows += [(1000 + k, " ".join(rng.choice(words, 60)).title()) for k in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(100 * c + k, k) for c in range(4) for k in range(len(items))}


def brute_literal(docs, items):
    """Documents that hold at least six (or all) lower-cased windows of eight tokens of an item, by comparing lists."""
    tokens = lambda t: re.findall(r"\w+", (t or "").lower())
    out = set()
    for k, text in docs:
        own = tokens(text)
        for i, item in items:
            words = tokens(item)
            n = min(8, len(words))
            have = {tuple(own[p : p + n]) for p in range(len(own) - n + 1)}
            all_ = [tuple(words[p : p + n]) for p in range(len(words) - n + 1)] if words else []
            if all_ and sum(w in have for w in all_) >= min(6, len(all_)):
                out.add((k, i))
    return out


def test_decontamination_against_brute_force(spark, sf):
    """Pieces of items, in any letter case, put into documents: at least those that the literal rule finds, and no others where items hold no slots."""
    rng = np.random.default_rng(9)
    items = [(k, " ".join(re.findall(r"[a-z]+", r.text.lower()))) for k, r in enumerate(spark.read.parquet(f"{sf}/benchmark.parquet").collect())][:40]
    docs = []
    for k in range(200):
        words = items[int(rng.integers(0, len(items)))][1].split()
        lo = int(rng.integers(0, max(1, len(words) - 5)))
        part = " ".join(words[lo : lo + int(rng.integers(5, 25))])
        docs.append((k, "before it " + [part, part.upper(), part.title()][k % 3] + " and after it"))
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_literal(docs, items) and 20 < len(got) < 200


@pytest.fixture
def split_anew(spark):
    """Changes how files are split; as before afterwards."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, size)
    spark.conf.set(key, before)


def test_rewrite_after_other_splits(spark, tmp_path, split_anew):
    rows = [(None if k % 5 == 0 else k // 3, "same" if k % 4 == 0 else f"text {k} " * 20, k) for k in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(7).write.parquet(str(tmp_path / "d"), compression="none")
    d = spark.read.parquet(str(tmp_path / "d"))
    placed = sharding.reshard(d, 3, 4, blocks=64)
    placed = placed.sparkSession.createDataFrame(placed.collect(), placed.schema)  # as stored: nothing of it is computed again
    split_anew("4k")
    docs = spark.read.parquet(str(tmp_path / "d")).orderBy(F.rand(3))  # other splits, another order
    out = spark.read.parquet(sharding.rewrite_affected(docs, placed))
    assert Counter((r.doc_id, r.text, r.place) for r in out.select("doc_id", "text", "place").collect()) == Counter(rows)
    wrong = placed.withColumn("text_crc32", F.col("text_crc32") + F.when(F.col("slot") == 0, 1).otherwise(0))
    with pytest.raises(RuntimeError, match="does not hold"):
        sharding.rewrite_affected(docs, wrong)


def test_near_duplicates_after_other_splits(spark, tmp_path, split_anew, monkeypatch):
    import corpus_pipeline

    base = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(40)]
    rows = [(k, base[k // 2] + (" end" if k % 2 else "")) for k in range(80)] + [(200 + k, f"alone {k} " * 8) for k in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d"), compression="none")
    found = corpus_pipeline.set_join.jaccard_components

    def then_split(docs):
        out = written(found(docs), "test")
        split_anew("2k")
        return out

    monkeypatch.setattr(corpus_pipeline.set_join, "jaccard_components", then_split)
    left = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()}
    want = {k for k, t in rows if k % 2 == 0 or k >= 200}
    assert {k for k in left if k < 200} == {k for k in want if k < 200}


def test_sequences_refuse_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "three"), (2, "four")], "doc_id long, text string")
    with pytest.raises(ValueError, match="id of its own"):
        packing.sequences(docs, packing.best_fit(docs))
