"""URL filters: fixed host/path rules, then mined association rules.

A url's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
A-Z lower-cased; its path goes on up to ``?``, ``#`` or the end. A null url, or one
without ``://``, has an empty host and path. A fixed rule fits its host and all
subdomains where the path starts with the rule's; the longest fitting rule decides.

Urls that no fixed rule fits are judged by rules mined from labelled urls. Spark's
FP-growth finds the frequent combinations of url tokens with the label; a
combination blocks if at least ``min_rows`` bad urls (and ``min_support`` of all) hold it, its
confidence and lift suffice, its surplus over the share of bad urls is at least ``min_z`` standard
errors, and no part of it does as well. A url brings all its frequent items. So that the combinations stay few, tokens that stand in the same rows
count as one item (its rules name them all), and FP-growth gets the rows of one item at a time, with
the more frequent items there: without those that stand in all of these rows, and those that stand in the
same of them as one. A combination without a good url isn't grown further. None of this loses a
rule, since a part does as well. Rules are matched by an inverted index: each stands under its rarest token,
urls look up their tokens there, and the rest of the rule is checked on the spot.
With nothing mined, every such url is allowed.

Null urls and labels teach nothing; repeated urls count as often as they stand. Of several
matching rules the most confident is reported, then the better supported, then by its text. Empty tables give no
rules and no rows; very long urls are read whole; other columns aren't read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import materialise

BAD = -1  # FP-growth's item for the label
# The rule list that the query applies, (verdict, rule).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.when(has, lower), F.lit("")), F.coalesce(F.when(has, path), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """Struct (verdict, rule) of the longest fitting rule, or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def url_tokens(url: Column) -> Column:
    """Distinct tokens: domain endings by length, path words (digits as 0), query keys and their values."""
    host, path = host_and_path(url)
    labels = F.split(host, r"\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, -i, i), ".")),
    )
    words = F.transform(F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "0"), r"[^\p{L}0]+"), lambda w: F.concat(F.lit("path:"), w))
    query = F.coalesce(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    pairs = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("query:"), p))
    keys = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("query:"), F.split(p, "=")[0]))
    every = F.array_distinct(F.concat(F.when(host != "", ends).otherwise(F.array().cast("array<string>")), words, pairs, keys))
    return F.filter(every, lambda t: ~F.endswith(t, F.lit(":")))


NO_RULES = "tokens array<string>, anchor string, confidence double, support double"


def _count(rows: DataFrame, *by: str) -> DataFrame:
    """By the columns ``by``: rows, bad ones, and two sums of row hashes that stand for the set of rows."""
    row_set = [F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x")]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad"), *row_set)


def _items(rows: DataFrame, least: int) -> DataFrame:
    """(item, of, n, n_bad): the tokens in at least ``least`` bad rows, those of equal row sets as one
    item (named by its smallest), and the numbers of its rows."""
    tokens = _count(rows.select("row", "bad", F.explode("tokens").alias("t")), "t").filter(F.col("n_bad") >= least)
    merged = tokens.groupBy("n", "n_bad", "s", "x").agg(F.min("t").alias("item"), F.sort_array(F.collect_list("t")).alias("of"))
    return merged.select("item", "of", "n", "n_bad")


def _pairs(held: DataFrame, items: DataFrame, least: int) -> DataFrame:
    """(item, with, n, n_bad, class): each item with the more frequent ones in at least ``least`` bad rows
    and not in all rows of it. A class: those that stand in the same rows of the item. No part is without good rows."""
    open_items = F.sort_array(F.collect_list(F.struct("n", "item")))["item"]
    mixed = held.join(items.filter("n_bad < n").select("item", "n"), "item")
    baskets = mixed.groupBy("row", "bad").agg(open_items.alias("items"))
    first = baskets.select("row", "bad", "items", F.posexplode("items").alias("at", "item"))
    both = first.select("row", "bad", "item", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("with"))
    pairs = _count(both, "item", "with").filter(F.col("n_bad") >= least)
    pairs = pairs.join(items.select("item", F.col("n").alias("n_item")), "item").filter("n < n_item")
    classes = pairs.groupBy("item", "n", "n_bad", "s", "x").agg(F.collect_list("with").alias("withs"))
    classes = classes.withColumn("class", F.monotonically_increasing_id())
    return classes.select("item", F.explode("withs").alias("with"), "n", "n_bad", "class")


def _grown(held: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """(items, n, n_bad): combinations of three items or more in at least ``least`` bad rows."""
    mixed = pairs.filter("n_bad < n")
    classes = mixed.groupBy("class", "item").agg(F.collect_list("with").alias("withs"), F.min("with").alias("with"))
    second = held.select("row", F.col("item").alias("with"))
    bases = held.join(classes.select("class", "item", "with"), "item").join(second, ["row", "with"])
    bases = bases.groupBy("row", "bad", "item").agg(F.collect_list("class").alias("items")).filter(F.size("items") > 1)
    bases = bases.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD).cast("long"))).otherwise(F.col("items")).alias("items"))
    bases = materialise(held.sparkSession, bases, "url-bases")
    # support is a share of the bases
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(1, bases.count()))).fit(bases).freqItemsets
    is_bad = F.array_contains("items", BAD)
    with_bad = found.filter(is_bad).select(F.array_sort(F.array_remove("items", BAD)).alias("of"), F.col("freq").alias("n_bad"))
    sets = found.filter(~is_bad & (F.size("items") > 1)).select(F.array_sort("items").alias("of"), F.col("freq").alias("n")).join(with_bad, "of")
    # one of each class, in every way
    members = sets.select("of", "n", "n_bad", F.explode("of").alias("class")).join(classes.select("class", "item", "withs"), "class")
    members = members.groupBy("of", "n", "n_bad", "item").agg(F.collect_list("withs").alias("lists"))
    ways = F.expr("aggregate(lists, array(array(item)), (ways, l) -> flatten(transform(ways, w -> transform(l, x -> array_append(w, x)))))")
    return members.select("n", "n_bad", F.explode(ways).alias("items")).select(F.array_sort("items").alias("items"), "n", "n_bad")


def _best(spark: SparkSession, sets: DataFrame) -> DataFrame:
    """The found ones of ``sets`` (items, n, n_bad, confidence, found) of which no part does as well. By size: a set is
    dropped, and what holds it, if one of its parts was, has no good rows, or stands in no more rows."""
    longest = sets.agg(F.max(F.size("items"))).first()[0] or 0
    kept = sets.limit(0).select("items", "n_bad", "confidence")
    below = None
    for size in range(1, longest + 1):
        level = sets.filter(F.size("items") == size)
        if below is None:
            level = level.withColumn("best_part", F.lit(0.0))
        else:
            parts = level.select("items", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("part"))
            parts = parts.join(below.filter("n_bad < n").select(F.col("items").alias("part"), F.col("n").alias("n_part"), "best"), "part")
            parts = parts.groupBy("items").agg(F.count(F.lit(1)).alias("parts"), F.min("n_part").alias("n_part"), F.max("best").alias("best_part"))
            level = level.join(parts.filter(F.col("parts") == size), "items").filter("n < n_part")
        best = F.greatest("best_part", F.when(F.col("found"), F.col("confidence")))
        below = materialise(spark, level.select("items", "n", "n_bad", "confidence", "found", "best_part", best.alias("best")), "url-level")
        kept = kept.union(below.filter("found and confidence > best_part").select("items", "n_bad", "confidence"))
    return kept


def mine_rules(
    labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.5, min_lift: float = 1.5, min_rows: int = 20, min_z: float = 4.0
) -> DataFrame:
    """``labelled`` has url and bad (boolean or null: skipped). Returns the
    blocking rules (tokens, anchor, confidence, support). A rule's tokens stand together in
    at least ``min_rows`` bad urls and in a share of ``min_support`` of all labelled ones."""
    spark = labelled.sparkSession
    rows = labelled.filter(F.col("bad").isNotNull() & F.col("url").isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), url_tokens(F.col("url")).alias("tokens"), "bad")
    rows = materialise(spark, rows, "url-labelled")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.sum(F.col("bad").cast("int"))).first()
    least = max(min_rows, math.ceil(min_support * n))
    if (n_bad or 0) < least:
        return spark.createDataFrame([], NO_RULES)
    items = materialise(spark, _items(rows, least), "url-items")
    held = rows.select("row", "bad", F.explode("tokens").alias("item")).join(items.select("item"), "item")
    pairs = materialise(spark, _pairs(held, items, least), "url-pairs")
    sets = items.select(F.array("item").alias("items"), "n", "n_bad")
    sets = sets.union(pairs.select(F.array_sort(F.array("item", "with")), "n", "n_bad")).union(_grown(held, pairs, least))
    base = n_bad / n
    sets = sets.withColumn("confidence", F.col("n_bad") / F.col("n"))
    standard_error = F.sqrt(F.lit(base * (1 - base)) / F.col("n"))
    surplus = F.col("confidence") - base >= min_z * standard_error
    found = (F.col("confidence") >= min_confidence) & (F.col("confidence") >= min_lift * base) & surplus
    kept = _best(spark, materialise(spark, sets.withColumn("found", found), "url-sets"))
    kept = kept.select("items", "confidence", (F.col("n_bad") / n).alias("support"), F.explode("items").alias("item")).join(items.select("item", "of", "n"), "item")
    kept = kept.groupBy("items", "confidence", "support").agg(
        F.sort_array(F.flatten(F.collect_list("of"))).alias("tokens"), F.min_by(F.col("of")[0], F.struct("n", "item")).alias("anchor")
    )
    return materialise(spark, kept.select("tokens", "anchor", "confidence", "support"), "url-index")


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule, confidence) of the distinct urls that a mined rule blocks."""
    tokens = urls.filter("url is not null").select("url").distinct().withColumn("url_tokens", url_tokens(F.col("url")))
    probes = tokens.withColumn("anchor", F.explode("url_tokens"))
    hits = probes.join(rules, "anchor").filter(F.size(F.array_except("tokens", "url_tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("tokens", " ").alias("rule"))).alias("best")
    return hits.groupBy("url").agg(best).select("url", F.col("best.rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, mined: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence); a row per row of ``pages``."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    hits = blocked_urls(rows.filter("fixed is null").select("url"), mined)
    joined = rows.join(hits, "url", "left")
    free = F.col("fixed").isNull()
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("fixed.rule").alias("rule"),
        F.when(~free, F.col("fixed.verdict")).when(F.col("mined_rule").isNotNull(), "block").otherwise("allow").alias("verdict"),
        F.when(free, F.col("mined_rule")).alias("mined_rule"),
        F.when(free, F.col("confidence")).alias("confidence"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the page's id: bad if any label row has quality 0 or toxic 1."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined = mine_rules(pages.join(bad, "page_id").select("url", "bad"))
    return judge(pages, mined)
