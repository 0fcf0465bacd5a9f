"""URL filter: a blocked Bloom filter before an exact hash join, in DataFrame functions only.

Listed keys are canonical URLs (``u:...``) and host/path rules (``r:...``). Each
key sets two bits in each of the four words of one 256-bit block. Every
distinct URL offers its own canonical form and the host suffixes and path
prefixes of the shapes that occur among the rules; what passes the Bloom filter
goes to an exact join on the key, which removes the false positives.

The filter and the exact list are broadcast only if their counted sizes are
below ``broadcast_bytes``; beyond that both are ordinary shuffled joins, where
adaptive execution splits a key that many URLs share. URLs are
judged once each and joined back, so a repeated URL costs one row.

Defined results: a null URL, or one without ``://``, has empty host and path, fits
no rule and, unlisted, is allowed. An empty list or an empty rule table
lists nothing. Of equally long fitting rules the alphabetically first wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
BITS_PER_KEY = 16
WORDS = 4
BROADCAST_BYTES = 32 << 20


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, sorted query without tracking parameters."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _word_masks(key: Column) -> list[Column]:
    """Two of 64 bits in each word, all from one hash of the key."""
    h = F.xxhash64(key, F.lit(1))
    bit = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(2 * WORDS)]
    one = F.lit(1).cast("long")
    # F.shiftleft takes only a plain number as the distance
    return [F.call_function("shiftleft", one, bit[2 * w]).bitwiseOR(F.call_function("shiftleft", one, bit[2 * w + 1]))
            for w in range(WORDS)]


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def blocked_bloom(keys: DataFrame, n_blocks: int) -> DataFrame:
    """``(block, w0..w3)`` of the column ``key``: one row per block that any key sets bits in."""
    masks = {f"m{w}": m for w, m in enumerate(_word_masks(F.col("key")))}
    rows = keys.select(_block(F.col("key"), n_blocks).alias("block"), *[m.alias(n) for n, m in masks.items()])
    return rows.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)])


def may_contain(candidates: DataFrame, bloom: DataFrame, n_blocks: int, small: bool) -> DataFrame:
    """The rows of ``candidates`` whose ``key`` all bits are set for (no false negatives)."""
    cols = candidates.columns
    probe = candidates.select("*", _block(F.col("key"), n_blocks).alias("block"),
                              *[m.alias(f"m{w}") for w, m in enumerate(_word_masks(F.col("key")))])
    hit = probe.join(F.broadcast(bloom) if small else bloom, "block")
    for w in range(WORDS):
        hit = hit.where(F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    return hit.select(*cols)


def listed_keys(urls: DataFrame | None, rules: DataFrame | None) -> DataFrame:
    """``(key, rule, action)``, one row per key, of ``urls(url)`` to block and ``rules(host, path, action)``.

    Of a rule given twice with different actions, ``block`` stands. Null urls, hosts or actions are ignored.
    """
    parts = []
    if urls is not None:
        canon = canonical_url(F.col("url"))
        parts.append(urls.where(F.col("url").isNotNull()).select(
            F.concat(F.lit("u:"), canon).alias("key"), F.lit(None).cast("string").alias("rule"),
            F.lit("block").alias("action")))
    if rules is not None:
        rule = F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit("")))
        parts.append(rules.where("host IS NOT NULL AND action IS NOT NULL").select(
            F.concat(F.lit("r:"), rule).alias("key"), rule.alias("rule"), F.col("action")))
    both = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    return both.groupBy("key").agg(F.first("rule").alias("rule"), F.max("action").alias("action"))


def judge_urls(pages: DataFrame, urls: DataFrame | None = None, rules: DataFrame | None = None,
               page_id: str = "page_id", url: str = "url", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per input row.

    The verdict is that of the longest fitting rule, else ``block`` if the
    canonical URL is listed, else ``allow``.
    """
    if urls is None and rules is None:
        raise ValueError("give urls, rules or both")
    listed = materialize(listed_keys(urls, rules))
    size = listed.agg(F.count("*").alias("n"), F.sum(F.octet_length("key") + 64).alias("b")).first()
    n_blocks = max(1, -(-size.n * BITS_PER_KEY // (64 * WORDS)))
    bloom = blocked_bloom(listed.select("key"), n_blocks)
    bloom_small, list_small = n_blocks * 8 * (WORDS + 1) <= broadcast_bytes, (size.b or 0) <= broadcast_bytes

    labels = F.size(F.split(F.regexp_extract("rule", r"^([^/]*)", 1), r"\."))
    shapes = listed.where("rule IS NOT NULL").select(
        labels.alias("labels"), F.length(F.regexp_extract("rule", r"^[^/]*(.*)$", 1)).alias("chars")).distinct()
    shapes = sorted((r.labels, r.chars) for r in shapes.collect())  # label counts x prefix lengths that occur

    each = pages.select(F.col(url).cast("string").alias("url")).distinct()
    each = each.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    own = F.split("host", r"\.")
    keys = [F.concat(F.lit("u:"), canonical_url(F.col("url")))] + [
        F.when((F.col("host") != "") & (F.size(own) >= n) & (F.length("path") >= c), F.concat(
            F.lit("r:"), F.array_join(F.slice(own, -n, n), "."), F.substring("path", 1, c)))
        for n, c in shapes]
    offered = each.where("host <> ''").select("url", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    possible = may_contain(offered, bloom, n_blocks, bloom_small)
    exact = possible.join(F.broadcast(listed) if list_small else listed, "key")
    best = exact.groupBy("url").agg(
        # a null order, that of listed URLs, is left out
        F.min_by(F.struct("rule", "action"), F.when(F.col("rule").isNotNull(), F.struct(
            -F.length("rule"), F.col("rule")))).alias("by_rule"),
        F.bool_or(F.col("rule").isNull()).alias("is_listed"))
    best = materialize(best.select("url", "by_rule.rule", F.coalesce(
        F.when(F.col("by_rule.rule").isNotNull(), F.col("by_rule.action")),
        F.when(F.col("is_listed"), F.lit("block"))).alias("verdict")))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    return rows.join(best, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
