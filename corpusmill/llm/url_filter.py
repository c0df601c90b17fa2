"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

1. The longest rule that fits a URL decides it. Rules are a short policy and become one expression.
2. The other URLs are looked up in a list of any length. The canonical URLs of the list set eight bits each, one in each word
   of one block of 512 bits; the blocks are a table of at most ``MAX_BLOCKS`` rows, and one block is read per URL.
3. What may be listed goes to an exact hash join with the list, which removes the false positives of the filter.

All of it is built-in expressions. A longer list than the filter is made for lets more URLs pass to the join; the verdicts
are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.names import unused
from corpusmill.sources.staging import stage

Rule = tuple[str, str, str]  # host, path, verdict

WORDS = 8  # 64-bit words of a block
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18  # 16 MB of bits: the table of blocks is sent to every task
MAX_RULES = 1000  # rules are an expression, not a table
PARTS = 16  # parts that the rows of one listed URL are dealt to
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """The host in lower case (A-Z); empty for a null URL or one without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to a query, a fragment or the end; empty for a null URL or one without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL: without scheme, user, default port, ``www.``, repeated and last slashes, fragment and tracking
    parameters, the other parameters sorted. Null without a host."""
    name = F.regexp_replace(host(url), r"^[^@]*@", "")
    name = F.regexp_replace(F.regexp_replace(name, r"(:(80|443)?)?$", ""), r"^www\.", "")
    place = F.regexp_replace(F.regexp_replace(path(url), "/+", "/"), "/$", "")
    asked = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(asked, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_[a-z]+|gclid|fbclid)="))
    listed = F.array_join(F.array_sort(kept), "&")
    return F.when(name != "", F.concat(name, place, F.when(listed != "", F.concat(F.lit("?"), listed)).otherwise("")))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    name, start, _ = rule
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(start)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as its text, and its verdict; both null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: give single URLs as a list")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the last condition is asked first
        fits = _fits(rule, host, path)
        text, verdict = F.when(fits, rule[0] + rule[1]).otherwise(text), F.when(fits, rule[2]).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _masks(key: Column) -> list[Column]:
    """One bit for each word of a block, from 6 bits each of a second hash."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def blocks_for(urls: int) -> int:
    """Blocks of a filter for so many URLs."""
    return max(1, min(MAX_BLOCKS, -(-urls * BITS_PER_URL // (64 * WORDS))))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, words): the blocks that hold a bit. At most ``blocks`` rows, combined in the tasks first."""
    set_bits = keys.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    merged = set_bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    return stage(merged.select("block", F.array(*[f"w{i}" for i in range(WORDS)]).alias("words")), "url-filter")


def _may_be_listed(rows: DataFrame, key: str, asked: Column, bloom: DataFrame, blocks: int, new: tuple[str, str]) -> DataFrame:
    """``rows`` with the second of ``new``: false only where the URL is certainly not listed. The first is used up."""
    block, may = new
    bits = bloom.select(F.col("block").alias(block), F.col("words").alias(may))
    found = rows.withColumn(block, F.when(asked, _block(F.col(key), blocks)))
    # At most MAX_BLOCKS rows of about 100 bytes.
    found = found.join(F.broadcast(bits), block, "left")
    hit = F.lit(True)
    for i, mask in enumerate(_masks(F.col(key))):
        hit &= F.get(may, F.lit(i)).bitwiseAND(mask) == mask
    return found.withColumn(may, F.coalesce(hit, F.lit(False))).drop(block)


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url", listed_url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The verdict is that of the longest rule that fits; without one, ``block`` if the canonical URL is among those of ``listed``
    and ``allow`` otherwise. A null URL, and one without ``://``, has an empty host and path, fits no rule and is allowed.
    Every row stays, repeated ones and those with nulls too; an empty table gives an empty result. Repeated and null rows of
    ``listed`` change nothing, an empty list blocks nothing. Columns of ``pages`` named host, path, rule or verdict are replaced.
    """
    key, part, block, may, found = unused(pages.columns, "key", "part", "block", "may", "found")
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    link = F.col(f"`{url}`")
    rows = pages.withColumns({key: canonical(link), part: host(link), block: path(link)})
    rows = rows.withColumns({"host": F.col(part), "path": F.col(block)}).drop(part, block)
    rows = rows.withColumns({"rule": text, "verdict": verdict})

    keys = stage(listed.select(canonical(F.col(f"`{listed_url}`")).alias(key)).where(F.col(key).isNotNull()).distinct(), "listed-urls")
    blocks = blocks_for(keys.count())
    asked = F.col("verdict").isNull() & F.col(key).isNotNull()
    rows = _may_be_listed(rows, key, asked, bloom_filter(keys, key, blocks), blocks, (block, may))

    # The list is cut down to what was asked for, each URL once: then neither side has a hot key.
    wanted = rows.where(may).select(key).distinct()
    hits = stage(keys.join(wanted.hint("shuffle_hash"), key, "left_semi"), "listed-hits")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias(part)
    dealt = rows.where(may).withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int"))
    sure = dealt.join(hits.select(key, parts, F.lit(True).alias(found)), [key, part], "left")
    sure = sure.withColumn("verdict", F.when(F.col(found), "block").otherwise("allow")).drop(part, found)
    rest = rows.where(~F.col(may)).withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    return rest.unionByName(sure).drop(key, may)
