"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Texts become tokens; numbers, names (capitalised words inside a sentence) and units after a number become
typed placeholders; the words of one name are one placeholder, so a name may become longer or shorter. Windows
of WINDOW template tokens are hash-joined with those of the benchmark items, so a question also matches
when its numbers or names were changed. Matches of one document, item and alignment then have their slots
compared: each name and unit of the benchmark must stand for one of the document and the reverse, else the
alignment does not count. Numbers are parameters of their own: two that were equal may differ, and the
reverse. A document is contaminated by an item if consistent alignments match at least MIN_WINDOWS of its
windows (or all, if it has fewer).

Copies as written are found whatever their letter case (a title-cased copy has other names): windows of the lower-cased
tokens, without placeholders, are hashed in the same pass over the texts and joined with those of all items.

Benchmark windows with fewer than MIN_LITERALS ordinary tokens match too easily as templates: only their tokens as
written count. An item without any other window is also found by its whole template (joined by its window with most ordinary tokens, then compared in full) if that holds at least
MIN_ITEM_LITERALS of them, and then its numbers too must be consistent, as there are few words to go by; with
fewer, any row of numbers would be a match and only verbatim copies count. An
item with fewer than WINDOW tokens is one window. The benchmark is broadcast only if its counted windows
are within BROADCAST_ROWS; likewise the ids of matched documents, for the scan that reads their slots.

Defined cases: null and empty texts have no windows; rows without an id are not reported; rows of one id count
as one document; repeated items count as themselves; empty tables give an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, named, written

WINDOW = 8
MIN_LITERALS = 5
MIN_WINDOWS = 6
MIN_ITEM_LITERALS = 3
BROADCAST_ROWS = 500_000
#: Units that count as such after a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "min", "h", "hr", "hours", "minutes", "seconds", "days", "weeks", "months", "years",
    "meters", "metres", "miles", "feet", "inches", "grams", "pounds", "liters", "litres", "dollars", "euros", "cents", "usd", "eur", "percent", "degrees",
    "hour", "minute", "second", "day", "week", "month", "year", "meter", "metre", "mile", "foot", "inch", "gram", "pound", "liter", "litre", "dollar", "euro", "cent",
    "yards", "acres", "gallons", "ounces", "pints", "tons", "tonnes", "kilometers", "kilometres", "kilograms", "volts", "watts",
)

#: How a benchmark window is joined: as a template, by its lower-cased tokens, or as the anchor of a whole item's template.
TEMPLATE, LITERAL, ANCHOR = 0, 1, 2

#: Placeholders, from a private range of characters.
_NUMBER, _NAME, _UNIT = "\ue001", "\ue002", "\ue003"
#: Stripped from both ends of a token, after all other characters between words became spaces.
_PUNCTUATION = ".,!?:"


def tokenised(rows: DataFrame, key: str) -> DataFrame:
    """key, raw (letters, marks, digits and .,!?: of any script between other characters), clean (raw without .,!?: around it; empty where nothing is left)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(". "))  # a line's first word begins a sentence
    text = F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}.,!?: ]+", " ")
    # Within a token .,!?: stay only between digits.
    text = F.regexp_replace(text, r"(?<!\p{N})([.,!?:]+)(?=[^ .,!?:])|([.,!?:]+)(?=[^ .,!?:\p{N}])", "$1$2 ")
    own = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.array_remove(F.split(text, " "), "").alias("raw"))
    return own.withColumn("clean", F.transform("raw", lambda w: F.btrim(w, F.lit(_PUNCTUATION))))


def canonical(w: Column, i: Column) -> Column:
    """The template token of the i-th clean token: number, name, unit or the lower-cased token itself."""

    def number(x: Column) -> Column:
        return (x >= "0") & (x < ":") | (x >= "\u00b2") & x.rlike(r"^\p{N}")

    before = F.get("raw", i - 1)
    inside = (i > 0) & ~(before.endswith(".") | before.endswith("!") | before.endswith("?") | before.endswith(":"))
    first, second = F.substring(w, 1, 1), F.substring(w, 2, 1)
    name = inside & (second != F.upper(second))
    unit = (i > 0) & number(F.get("clean", i - 1))
    plain = (w >= "a") & (w < "{")
    small = F.when(w.isin(*UNITS), F.when(unit, _UNIT).otherwise(w)).otherwise(F.lower(w))
    return F.when(plain, small).when(number(w), _NUMBER).when((first != F.lower(first)) & name, _NAME).otherwise(F.lower(w))


def arrays_of(rows: DataFrame, key: str) -> DataFrame:
    """key, template and clean (the tokens as written), of equal length; of each name its first word only."""
    own = tokenised(rows, key).withColumn("template", F.transform("clean", canonical))
    own = own.select(key, F.array_remove("template", "").alias("template"), F.array_remove("clean", "").alias("clean"))
    kept = F.array_compact(F.transform("template", lambda t, i: F.when((t == _NAME) & (F.get("template", i - 1) == _NAME), F.lit(None)).otherwise(i)))
    own = own.withColumn("kept", kept)
    of = lambda c: F.transform("kept", lambda i: F.get(c, i)).alias(c)
    return own.select(key, of("template"), of("clean"))


def templated(rows: DataFrame, key: str) -> DataFrame:
    """key, words (lower-cased) and template, of equal length."""
    return arrays_of(rows, key).select(key, F.transform("clean", lambda w: F.lower(w)).alias("words"), "template")


def token_hashes(rows: DataFrame, key: str) -> DataFrame:
    """key, template and literal: the hashes of the template's tokens (of each name its first word only) and of all lower-cased tokens."""
    none, name = F.xxhash64(F.lit("")), F.xxhash64(F.lit(_NAME))
    both = F.transform("clean", lambda w, i: F.struct(F.xxhash64(canonical(w, i)).alias("t"), F.xxhash64(F.lower(w)).alias("l")))
    own = tokenised(rows, key).select(key, both.alias("h"))
    own = own.select(key, F.array_remove(F.col("h.t"), none).alias("t"), F.array_remove(F.col("h.l"), none).alias("literal"))
    return own.select(key, F.filter("t", lambda x, i: (x != name) | F.coalesce(F.get("t", i - 1) != name, F.lit(True))).alias("template"), "literal")


def windows_of(rows: DataFrame, sizes: dict[str, list[int]], *keep: str) -> DataFrame:
    """literal, size, place, w for each window of the sizes over the named columns of token hashes: one pass, whatever the number of sizes.

    A window's hash is built by doubling (two tokens, four, eight): each step reads one more place. Windows of one column
    and size are one array; all are exploded together. The outer explode and the late filter keep Spark from
    deriving a filter that would compute the arrays again.
    """
    half = lambda k: 1 << ((k - 1).bit_length() - 1) if k > 1 else 0
    own, each = rows, []
    for column, wanted in sizes.items():
        own, done = own.withColumn(f"{column}1", F.col(column)), 1
        while done < max(half(k) for k in wanted):
            own, done = own.withColumn(f"{column}{2 * done}", _doubled(f"{column}{done}", done)), 2 * done
        for k in wanted:
            whole = _doubled(f"{column}{half(k)}", k - half(k)) if k > 1 else F.col(f"{column}1")
            told = F.struct(F.lit(column == "literal").alias("literal"), F.lit(k).alias("size"), F.size(column).alias("n"), whole.alias("ws"))
            each.append(told)
    runs = own.select(*keep, F.explode(F.array(*each)).alias("x")).select(*keep, "x.*")
    out = runs.select(*keep, "literal", "size", "n", F.posexplode_outer("ws").alias("place", "w"))
    return out.where(F.col("place") <= F.col("n") - F.col("size")).select(*keep, "literal", "size", "place", "w")


def _doubled(h: str, step: int) -> Column:
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, words, template) of each item and (item_id, kind, size, at, w) of its windows."""
    repeated = benchmark.dropDuplicates(["item_id", "text"])
    items = templated(repeated, "item_id").where(F.size("template") > 0)
    own = arrays_of(repeated, "item_id").where(F.size("template") > 0)
    literal = lambda x: ~x.isin(_NUMBER, _NAME, _UNIT)
    n = F.size("template")
    size = F.least(F.lit(WINDOW), n)
    at = F.explode(F.sequence(F.lit(0), n - size)).alias("at")
    each = own.select("item_id", "template", "clean", size.alias("size"), F.size(F.filter("template", literal)).alias("item_literals"), at)
    each = each.withColumn("literals", F.size(F.filter(F.slice("template", F.col("at") + 1, F.col("size")), literal)))
    each = each.withColumn("usable", F.col("literals") >= F.least(F.lit(MIN_LITERALS), F.col("size")))
    # One row for each item and text: its windows, whether any is usable, and the place of the one with most literals.
    text = ["item_id", "template", "clean"]
    best = each.groupBy(*text).agg(F.max("usable").alias("any"), F.max_by("at", F.struct("literals", -F.col("at"))).alias("best"))
    each = each.join(best, text)
    kinds = F.array_compact(
        F.array(
            F.when(F.col("usable"), TEMPLATE),
            F.when(~F.col("any") & (F.col("at") == F.col("best")) & (F.col("item_literals") >= MIN_ITEM_LITERALS), ANCHOR),
        )
    )
    each = each.select("item_id", "template", "size", "at", F.explode(kinds).alias("kind"))
    tokens = F.slice("template", F.col("at") + 1, F.col("size"))
    each = each.select("item_id", "kind", "at", F.col("size").alias("own_size"), F.transform(tokens, lambda x: F.xxhash64(x)).alias("template"))
    every = windows_of(each, {"template": list(range(1, WINDOW + 1))}, "item_id", "kind", "own_size", "at")
    every = every.where("size = own_size").select("item_id", "kind", "size", "at", "w")
    written_out = token_hashes(repeated, "item_id").select("item_id", "literal", F.least(F.lit(WINDOW), F.size("literal")).alias("own_size"))
    written_out = windows_of(written_out, {"literal": list(range(1, WINDOW + 1))}, "item_id", "own_size").where("size = own_size")
    return items, every.unionByName(written_out.select("item_id", F.lit(LITERAL).alias("kind"), "size", F.col("place").alias("at"), "w"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows of every contamination."""
    items, windows = benchmark_windows(benchmark)
    windows = written(windows, "benchmark")
    literal = F.col("kind") == LITERAL
    counted = windows.groupBy(literal.alias("literal"), "size").agg(F.count("*").alias("n")).collect()  # at most 2 * WINDOW rows
    if not counted:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_windows long")
    n_windows = sum(r.n for r in counted)
    sizes = {name: sorted(r["size"] for r in counted if r.literal == is_literal) for name, is_literal in (("template", False), ("literal", True))}
    of = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    usable = windows.groupBy("item_id").agg(of(TEMPLATE).alias("usable"), of(LITERAL).alias("every"))
    own = windows.select("item_id", "kind", literal.alias("own_literal"), F.col("size").alias("own_size"), "at", "w")
    each = windows_of(token_hashes(docs, "doc_id"), {k: v for k, v in sizes.items() if v}, "doc_id")
    found = each.join(broadcast_if_small(own, n_windows, BROADCAST_ROWS), "w").where("size = own_size and literal = own_literal")
    # Of a literal window it only counts that it is there, wherever.
    shift = F.when(F.col("kind") == LITERAL, 0).otherwise(F.col("place") - F.col("at")).alias("shift")
    aligned = found.select("doc_id", "item_id", "kind", shift, "at", "size").groupBy("doc_id", "item_id", "kind", "shift", "size").agg(F.collect_set("at").alias("ats"))
    all_aligned = written(aligned, "aligned")
    aligned = all_aligned.where(F.col("kind") != LITERAL)

    ids = written(aligned.select("doc_id").distinct(), "matched")
    few = broadcast_if_small(ids, ids.count(), BROADCAST_ROWS)
    texts = templated(docs.join(few, "doc_id", "left_semi"), "doc_id").select("doc_id", F.col("words").alias("doc_words"), F.col("template").alias("doc_template"))
    item_words = items.select("item_id", F.col("words").alias("item_words"), "template")
    full = aligned.join(texts, "doc_id").join(item_words, "item_id")
    whole = F.size("template")
    same = (F.col("shift") >= 0) & (F.slice("doc_template", F.greatest(F.col("shift"), F.lit(0)) + 1, whole) == F.col("template"))
    full = full.where((F.col("kind") != ANCHOR) | same)
    full = full.withColumn("ats", F.when(F.col("kind") == ANCHOR, F.sequence(F.lit(0), whole - F.col("size"))).otherwise(F.col("ats")))
    covered = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + F.col("size") - 1))))
    slots = F.filter(covered, lambda p: F.get("template", p).isin(_NAME, _UNIT) | (F.get("template", p) == _NUMBER) & (F.col("kind") == ANCHOR))
    pair = F.transform(slots, lambda p: F.struct(F.get("item_words", p).alias("item"), F.get("doc_words", p + F.col("shift")).alias("doc")))
    full = full.select("doc_id", "item_id", "kind", "shift", "ats", F.array_distinct(pair).alias("pairs"))
    # Consistent: as many pairs as values on either side.
    sides = [F.size(F.array_distinct(F.col(f"pairs.{s}"))) for s in ("item", "doc")]
    good = full.where((F.size("pairs") == sides[0]) & (F.size("pairs") == sides[1]))
    ats = good.select("doc_id", "item_id", "kind", "ats").union(all_aligned.where(literal).select("doc_id", "item_id", "kind", "ats"))
    at = ats.select("doc_id", "item_id", "kind", F.explode("ats").alias("at")).groupBy("doc_id", "item_id")
    total = at.agg(
        F.countDistinct(F.when(~literal, F.col("at"))).alias("by_template"), F.countDistinct(F.when(F.col("kind") == TEMPLATE, F.col("at"))).alias("templates"),
        F.countDistinct(F.when(literal, F.col("at"))).alias("literals"), F.max(F.col("kind") == ANCHOR).alias("whole"),
    )
    total = total.join(F.broadcast(usable) if n_windows <= BROADCAST_ROWS else usable, "item_id")
    by_template = (F.col("usable") > 0) & (F.col("templates") >= F.least(F.lit(MIN_WINDOWS), F.col("usable")))
    by_literal = F.col("literals") >= F.least(F.lit(MIN_WINDOWS), F.col("every"))
    return total.where(by_template | by_literal | F.col("whole")).select("doc_id", "item_id", F.greatest("by_template", "literals").alias("n_windows"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids, n_windows of each contaminated document."""
    m = matches(docs, benchmark)
    return m.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("item_ids"), F.sum("n_windows").alias("n_windows"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the contaminated ones."""
    bad = written(matches(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(broadcast_if_small(bad, bad.count(), BROADCAST_ROWS), "doc_id", "left_anti").select(*(named(c) for c in docs.columns))
