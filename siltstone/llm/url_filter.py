"""URL filtering by association rules.

FP-growth finds combinations of URL tokens that go with bad pages in labelled rows, as rules
"tokens -> bad". Rules below a support or confidence are not made; of the rest, a rule goes when a
rule of fewer of its tokens is as confident. Matching is by an inverted index: each rule is listed
under its rarest token alone, a URL looks up its own tokens, and a listed rule fits when the URL has
all of its tokens. A URL that a rule fits is blocked, another is allowed. Written rules of host and
path come before mined ones: one fits a host and its subdomains when the path starts with its path,
and the longest that fits decides.

Mining takes labelled rows up to SAMPLE_ROWS, thinned beyond that by a hash of the id. With a support
that is a share of the sample, rules are bounded by the sample and small enough to send along;
applying them reads every row once, without a shuffle. Rules have up to ``longest`` tokens, a parameter.

FP-growth gives every subset of the tokens that long bad URLs share, so tokens that occur in the very same
rows are mined as one: any of them fits where it stands in a rule, and a rule of two of them would be as
confident as one of either. Where so many rows are still wider than WIDE that a set as wide could be frequent, combinations are counted level
by level up to ``longest``, which gives the same rules.

Defined cases: a null URL, or one without ``://``, has empty host and path, no tokens and is allowed;
an empty table gives no rows; without labelled rows, or bad ones, there are no mined rules; repeated
rows are judged each; a long URL is taken whole; other columns are not touched.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import ceil

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parquet, ship, written

SAMPLE_ROWS = 100_000
MIN_SUPPORT, MIN_CONFIDENCE, LONGEST = 0.005, 0.6, 3
#: Different tokens of a row up to which FP-growth gives all their subsets.
WIDE = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The written rules of the contract: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def written_rule(host_col: Column, path_col: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):  # later is longer and goes first
        fits = ((host_col == h) | F.endswith(host_col, F.lit("." + h))) & F.startswith(path_col, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(host_col: Column, path_col: Column) -> Column:
    """Distinct tokens of a URL: host suffixes, the labels of the host, and the parts of the path with their kind."""
    labels = F.filter(F.split(host_col, r"\."), lambda x: x != "")
    hosts = F.transform(labels, lambda x: F.concat(F.lit("h:"), x))
    parts = F.filter(F.split(F.translate(path_col, UPPER, LOWER), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    paths = F.transform(parts, lambda x: F.when(F.rlike(x, F.lit("^[0-9]+$")), F.concat(F.lit("n:"), F.length(x).cast("string"))).otherwise(F.concat(F.lit("p:"), x)))
    return F.array_distinct(F.concat(hosts, paths))


def merged(rows: DataFrame, least: int) -> dict[str, str]:
    """Each token that at least so many bad rows have, and the smallest token of those that occur in the very same rows."""
    each = rows.select("row", "bad", F.explode(F.array_distinct("items")).alias("item")).where("item is not null")
    marks = each.groupBy("item").agg(F.count_if("bad").alias("n"), F.count(F.lit(1)).alias("all"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("y")).where(F.col("n") >= least)
    got = marks.collect()  # a row of so many tokens has at most so many, and support is a share of the rows of the sample
    first: dict[tuple, str] = {}
    for r in sorted(got, key=lambda r: r["item"]):
        first.setdefault((r["all"], r["x"], r["y"]), r["item"])
    return {r["item"]: first[r["all"], r["x"], r["y"]] for r in got}


def _level(size: int, known: set[tuple[str, ...]]):
    """Counts of the combinations of so many tokens whose smaller ones are all known."""
    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for items in batch.column(0).to_pylist():
                seen.update(c for c in combinations(sorted(items), size) if all(x in known for x in combinations(c, size - 1)))
        yield pa.RecordBatch.from_arrays([pa.array([list(c) for c in seen], pa.list_(pa.string())), pa.array(list(seen.values()), pa.int64())], names=["items", "freq"])
    return run


def frequent(bad: DataFrame, least: int, total: int, longest: int) -> list[tuple[tuple[str, ...], int]]:
    """(tokens, rows) of the combinations of up to ``longest`` tokens that at least so many of the rows (items) have."""
    # fewer wide rows than a set needs can't make a wide set frequent, whatever is in them
    if bad.where(F.size("items") > WIDE).count() < least:
        sets = FPGrowth(itemsCol="items", minSupport=least / total, minConfidence=0.0).fit(bad).freqItemsets.where(F.size("items") <= longest)
        return [(tuple(sorted(r["items"])), r["freq"]) for r in sets.toLocalIterator() if r["freq"] >= least]
    found, known = [], {()}
    for size in range(1, longest + 1):
        got = bad.mapInArrow(_level(size, known), "items array<string>, freq bigint").groupBy("items").agg(F.sum("freq").alias("freq")).where(F.col("freq") >= least)
        level = [(tuple(r["items"]), r["freq"]) for r in got.toLocalIterator()]
        found, known = found + level, {s for s, _ in level}
    return found


def mine(rows: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, longest: int = LONGEST) -> tuple[list[tuple[tuple[str, ...], float, float]], dict[str, str]]:
    """(tokens, confidence, support) of the rules kept, and the token by which each token is named in them. rows: (items, bad boolean).

    The labelled bad rows alone are searched for frequent sets, as a rule's support is its number of
    bad rows, and one pass over the sample then counts each set among all of them.
    """
    ship(rows.sparkSession)
    rows = written(rows.select(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "bad").withColumn("row", F.monotonically_increasing_id()))
    total, n_bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if not n_bad:
        return [], {}
    least = max(ceil(min_support * total - 1e-9), 2)
    names = merged(rows, least)
    if not names:
        return [], {}

    def named(batches):
        for batch in batches:
            items = [sorted({names[x] for x in row if x in names}) for row in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string())), batch.column(1)], names=["items", "bad"])

    rows = written(rows.select("items", "bad").mapInArrow(named, "items array<string>, bad boolean"))
    bad = rows.where("bad and size(items) > 0").select("items")
    sets = frequent(bad, least, max(1, bad.count()), longest)
    if not sets:
        return [], {}
    index = Index([s for s, _ in sets])

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for items in batch.column(0).to_pylist():
                seen.update(index.fitting(items))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["rule", "n"])

    counted = rows.select("items").mapInArrow(count, "rule bigint, n bigint").groupBy("rule").agg(F.sum("n").alias("n")).collect()
    among = {r.rule: r.n for r in counted}
    found = {s: (k / among[i], k / total) for i, (s, k) in enumerate(sets) if among.get(i) and k / among[i] >= min_confidence}
    kept: dict[tuple[str, ...], tuple[float, float]] = {}
    for s in sorted(found, key=lambda s: (len(s), s)):
        smaller = [kept[t][0] for k in range(len(s)) for t in combinations(s, k) if t in kept]
        if not smaller or found[s][0] > max(smaller):
            kept[s] = found[s]
    used = {x for s in kept for x in s}
    return [(s, *kept[s]) for s in sorted(kept)], {x: y for x, y in names.items() if y in used}


class Index:
    """Rules under their rarest token."""

    def __init__(self, rules: list[tuple[str, ...]]):
        often = Counter(x for r in rules for x in r)
        self.rules = [frozenset(r) for r in rules]
        self.lists: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            self.lists.setdefault(min(r, key=lambda x: (often[x], x)), []).append(i)

    def fitting(self, items) -> list[int]:
        have = set(items)
        return [i for x in have for i in self.lists.get(x, ()) if self.rules[i] <= have]


def judge(urls: DataFrame, mined: list[tuple[tuple[str, ...], float, float]], rules: list[tuple[str, str, str]], names: dict[str, str] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, mined_rule (tokens of the most confident mined rule that fits), confidence."""
    ship(urls.sparkSession)
    index = Index([s for s, _, _ in mined])
    by = [(c, " ".join(s)) for s, c, _ in mined]

    def run(batches):
        for batch in batches:
            named = ([names.get(x) for x in items] if names is not None else items for items in batch.column(4).to_pylist())
            best = [max((by[i] for i in index.fitting(items)), default=(None, None)) for items in named]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(5), pa.array([b for _, b in best], pa.string()), pa.array([c for c, _ in best], pa.float64())],
                                             names=["id", "host", "path", "rule", "verdict", "mined_rule", "confidence"])

    parsed = urls.select(F.col(id_col).cast("bigint").alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    rule, verdict = written_rule(F.col("host"), F.col("path"), rules)
    asked = parsed.select("id", "host", "path", rule.alias("rule"), tokens(F.col("host"), F.col("path")).alias("items"), verdict.alias("verdict"))
    got = asked.mapInArrow(run, "id bigint, host string, path string, rule string, verdict string, mined_rule string, confidence double")
    return got.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined_rule", "confidence")


def labelled(pages: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(items, bad) of labelled pages: a page goes with the labels of its number; bad is toxic or of no quality."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).alias("bad"))
    n = marks.count()
    if n > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    return pages.join(marks, "page_id").select(tokens(host(F.col("url")), path(F.col("url"))).alias("items"), "bad")


def op2_url_rules(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = parquet(spark, sf_dir, "pages").select("page_id", "url")
    mined, names = mine(labelled(pages, parquet(spark, sf_dir, "labels")))
    return judge(pages, mined, RULES, names).drop("mined_rule")


#: Every combination of up to three tokens, counted. Pruning leaves out what a smaller rule says as surely, so it changes neither verdict nor confidence.
OP2_SQL = r"""
with u as (select page_id, coalesce(url, '') as url from pages),
p as (select page_id, translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from u),
t as (select *, list_distinct(list_concat(list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
  list_transform(list_filter(regexp_split_to_array(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{L}\p{N}]+'), lambda x: x <> ''),
    lambda x: case when regexp_full_match(x, '[0-9]+') then 'n:' || length(x) else 'p:' || x end))) as items from p),
l as (select doc_id as page_id, bool_or(coalesce(toxic, 0) = 1 or coalesce(quality, 1) = 0) as bad from labels where doc_id is not null group by 1),
e as (select page_id, host, path, unnest(items) as x from t),
c as (select page_id, [x] as s from e union all select a.page_id, [a.x, b.x] from e a join e b on a.page_id = b.page_id and a.x < b.x
  union all select a.page_id, [a.x, b.x, c.x] from e a join e b on a.page_id = b.page_id and a.x < b.x join e c on c.page_id = b.page_id and b.x < c.x),
g as (select s, count(*) as n, count(*) filter (bad) as k from c join l using (page_id) group by s),
r as (select s, k / n as confidence from g where k >= greatest(2, ceil(0.005 * (select count(*) from pages join l using (page_id)) - 1e-9)) and k / n >= 0.6),
m as (select page_id, max(confidence) as confidence from c join r using (s) group by 1),
w(h, q, said) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f as (select page_id, arg_max(h || q, length(h || q)) as rule, arg_max(said, length(h || q)) as said from p join w on (host = h or host like '%.' || h) and starts_with(path, q) group by 1)
select page_id, host, path, rule, coalesce(said, case when confidence is null then 'allow' else 'block' end) as verdict, confidence from p left join f using (page_id) left join m using (page_id)
"""
