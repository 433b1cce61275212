"""URL verdicts: prefix rules, and a blocked Bloom filter before an exact join.

The filter of listed canonical URLs is a table of 512-bit blocks: eight longs,
one bit of each per URL, the block chosen by a second hash. It has at most
``MOST_BLOCKS`` rows (8 MB), so it is broadcast whatever the list's length;
a fuller filter lets more through, never less. Only URLs that it passes are
shuffled, to a join with the list itself, which removes false positives.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import only
from blotter.runtime import materialise

#: (action, host with path) in the order of the contract.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
WORDS = 8
BITS_PER_URL = 16
MOST_BLOCKS = 1 << 17
#: A hot URL's rows are spread over so many keys in the exact join.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
JUNK_HOST = r"(^|[.-])(bets|casino|pills|spam)([.-]|$)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a final slash, sorted query without tracking.

    Scheme and fragment are left out; a null URL or one without ``://`` gives
    the empty text.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    kept = F.array_join(parts, "&")
    whole = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(url.contains("://"), whole).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its action) of the longest rule that fits, else nulls."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _hashed(key: Column, blocks: int) -> list[Column]:
    """The block of a key and its bit in each of the block's longs."""
    bits = F.xxhash64(key)
    block = F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))
    one = F.lit(1).cast("long")
    masks = [
        F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * j).bitwiseAND(63).cast("int"))
        for j in range(WORDS)
    ]
    return [block.alias("block"), *[m.alias(f"m{j}") for j, m in enumerate(masks)]]


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block that is not empty: ``block``, ``w0`` to ``w7``. ``keys``: ``key``."""
    return (
        keys.select(*_hashed(F.col("key"), blocks))
        .groupBy("block")
        .agg(*[F.bit_or(f"m{j}").alias(f"w{j}") for j in range(WORDS)])
    )


def blocks_for(n: int) -> int:
    wanted = max(1, n * BITS_PER_URL // (64 * WORDS))
    return min(MOST_BLOCKS, 1 << (wanted - 1).bit_length())


def in_list(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """``rows`` (with ``key``) and ``listed``: whether the list has the key.

    ``listed`` is a stored table of distinct, non-empty ``key``. The rows that
    the filter stops are read once more rather than shuffled.
    """
    blocks = blocks_for(listed.count())
    bloom = bloom_filter(listed, blocks)
    possible = F.coalesce(_all_set(), F.lit(False))
    tested = (
        rows.withColumn("h", F.struct(*_hashed(F.col("key"), blocks)))
        .join(F.broadcast(bloom), F.col("h.block") == F.col("block"), "left")
        .withColumn("possible", possible)
        .select(*rows.columns, "possible")
    )
    stopped = tested.where(~F.col("possible")).select(*rows.columns, F.lit(False).alias("listed"))
    salted = tested.where("possible").withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    exact = listed.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    exact = exact.withColumn("found", F.lit(True))
    joined = salted.join(exact, ["key", "salt"], "left").select(
        *rows.columns, F.coalesce("found", F.lit(False)).alias("listed")
    )
    return stopped.unionByName(joined)


def _all_set() -> Column:
    out = F.lit(True)
    for j in range(WORDS):
        out = out & (F.col(f"w{j}").bitwiseAND(F.col(f"h.m{j}")) == F.col(f"h.m{j}"))
    return out


def listed_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list that grows with the table: canonical URLs of hosts named like junk."""
    url = F.col("url")
    named = only(pages, url=url_col).where(host_of(url).rlike(JUNK_HOST)).select(canonical(url).alias("key"))
    return materialise(named.where("key <> ''").distinct(), "listed-urls")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``listed`` for every row.

    A rule's verdict wins; without a rule a listed URL is blocked and any
    other allowed. Null URLs have empty host and path, no rule, and are
    allowed. Repeated rows are judged each.
    """
    source = only(pages, page_id=id_col, url=url_col)
    rows = source.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("key"),
    )
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return in_list(rows, listed).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(action, by_list).alias("verdict"), "listed"
    )
