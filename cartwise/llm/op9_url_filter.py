"""URL filters by Bloom filter cascades.

A key is a host followed by a path prefix (``example.com/de/``). A url has one candidate
key for each pair of host length (in labels) and path length that the rules have. Level 0
of a cascade encodes the listed keys, level 1 the keys of the corpus that pass level 0
without being listed, level 2 the listed keys that pass level 1, and so on until no key of
the corpus is told wrongly. Membership of a corpus key is then exact and needs no join.
Two cascades are used: one of all rules' keys, one of those that block.

Only keys that pass level 0 are ever gathered (distinct, in the shared folder). Level 0 is
sized by the ratio of corpus keys to listed keys, so that the levels stay within a few words
for each listed key; they travel with the plan as literals.

Null urls and urls without ``://`` have empty host and path; only rules fit, never the
empty key; without a rule the verdict is ``allow`` (not listed as blocked). Repeated rows are
judged alike. Other columns are not looked at, unless named in ``keep``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.session import materialize

#: Fixed values of the query: host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(C.ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, rules) -> Column:
    """The keys a rule could have that fits: array of (key, length, labels)."""
    labels = F.split(host, r"\.")
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p, _ in rules})
    found = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= size),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substr(path, F.lit(1), F.lit(size))),
        )
        for n, size in shapes
    ]
    rows = [
        F.when(k.isNotNull(), F.struct(F.length(k).alias("size"), F.lit(n).alias("labels"), k.alias("key")))
        for k, (n, _) in zip(found, shapes, strict=True)
    ]
    if not rows:
        return F.array().cast("array<struct<size:int,labels:int,key:string>>")
    return F.filter(F.array(*rows), lambda r: r.isNotNull())


class Level:
    """One Bloom filter: its words as a literal, and the test of a key."""

    def __init__(self, keys: DataFrame, count: int, bits_per_key: float, seed: int):
        self.bits = 64 * max(1, math.ceil(count * bits_per_key / 64))
        self.seeds = [seed * 64 + i for i in range(max(1, round(bits_per_key * math.log(2))))]
        places = F.explode(F.array(*[self._place(F.col("key"), s) for s in self.seeds])).alias("place")
        words = (
            keys.select(places)
            .groupBy((F.col("place") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
            .collect()
        )
        found = {r.word: r.bits for r in words}
        self.words = [found.get(i, 0) for i in range(self.bits // 64)]

    def _place(self, key: Column, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(self.bits))

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        test = F.lit(True)
        for seed in self.seeds:
            place = self._place(key, seed)
            word = F.get(words, F.floor(place / 64).cast("int"))
            test &= F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1
        return test


class Cascade:
    """Exact membership of ``listed`` keys for every key of the corpus.

    ``universe`` is every candidate key of the corpus (column ``key``, may repeat);
    ``size`` is about how many distinct ones there are. ``listed`` is a frame of keys.
    """

    def __init__(self, universe: DataFrame, size: int, listed: DataFrame, seed: int):
        listed = listed.select("key").distinct()
        count = listed.count()
        self.levels: list[Level] = []
        if not count:
            return
        first = Level(listed, count, 2 + 1.44 * math.log2(max(2.0, size / count)), seed)
        self.levels.append(first)
        # What passes level 0 is about as many keys as are listed: the false ones get level 1.
        passed = universe.where(first.has(F.col("key"))).select("key").distinct()
        wrong = materialize(passed.join(listed, "key", "left_anti"), "cascade")
        inside, outside = listed, wrong
        count = outside.count()
        while count:
            level = Level(outside, count, 4, seed + len(self.levels))
            self.levels.append(level)
            inside, outside = outside, inside.where(level.has(F.col("key")))
            count = outside.count()

    def has(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for at in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[at].has(key), out).otherwise(F.lit(at % 2 == 1))
        return out


def judge(pages: DataFrame, rules=RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep``, ``host``, ``path``, ``rule`` (the longest that fits; else null) and ``verdict``.

    Of two rules of one length the one with more host labels wins.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("_url"))
    rows = pages.select(*keep, F.col("url").alias("_url"))
    universe = rows.select(F.explode(F.transform(candidate_keys(host, path, rules), lambda r: r.key)).alias("key"))
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    keys = {h + p: v for h, p, v in rules}
    frame = lambda wanted: spark.createDataFrame([(k,) for k in wanted], "key string")
    ruled = Cascade(universe, size, frame(keys), 1)
    blocked = Cascade(universe, size, frame(k for k, v in keys.items() if v == "block"), 101)
    fits = F.array_max(F.filter(candidate_keys(host, path, rules), lambda r: ruled.has(r.key)))
    found = rows.select(*keep, host.alias("host"), path.alias("path"), fits.key.alias("rule"))
    verdict = F.when(F.col("rule").isNotNull() & blocked.has(F.col("rule")), "block").otherwise("allow")
    return found.withColumn("verdict", verdict)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    return judge(C.table(spark, sf_dir, "pages"))


SQL = """
WITH rules(host, path, verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (SELECT page_id, row_number() OVER () AS n,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, n,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
fits AS (SELECT p.*, r.host || r.path AS rule, r.verdict,
  row_number() OVER (PARTITION BY n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM parts p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""
