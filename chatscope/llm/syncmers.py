"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text is its sequence of words. Every run of ``s`` words is hashed; a run of
``k`` words is an anchor if the smallest of its inner run hashes is its first or
its last one. Whether a run is an anchor depends on its own words alone, so two
texts that share a passage share its anchors, wherever they stand; positions
let matches be lined up.

The fingerprint lists the anchors' 32-bit hashes in text order. The likeness of
two fingerprints is the Dice coefficient of their distinct anchors: 2 |A and B| /
(|A| + |B|), 1 for two without anchors. To give short texts anchors too,
``k - 1`` empty border words frame each text.

A word of more than ``LONG`` code points counts as that many one-character words, so that texts
without white space (Chinese, Japanese, minified code, base64) have anchors inside too. Shorter
pieces between white space stay whole, in any script.

Defined results: null and empty texts, and texts without a word, have an empty
fingerprint; equal texts have equal fingerprints. In the edit query the next
document follows in ascending id (nulls first, then the text); repeated ids
follow one another; the last is followed by the first; a single
document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatscope.llm.common import as_text, shuffle_width

K = 5
S = 2
LONG = 20  # code points of the longest word that is one word


def words_of(text: Column) -> Column:
    """Words between ASCII white space, those of more than ``LONG`` code points cut into characters."""
    words = F.array_remove(F.split(text, r"[\x09-\x0D\x20]+"), "")
    cut = F.flatten(F.transform(words, lambda w: F.when(F.length(w) > LONG, F.split(w, "(?s)(?<=.)(?=.)")).otherwise(F.array(w))))
    # few texts have such a word; the rest are split once
    return F.when(text.rlike(rf"(?:^|[\x09-\x0D\x20])[^\x09-\x0D\x20]{{{LONG + 1}}}"), cut).otherwise(words)


def _runs(words: Column, k: int, s: int) -> Column:
    """Hash of every run of ``s`` words of the framed text; empty for no words."""
    frame = F.array_repeat(F.lit(0).cast("long"), k - 1)
    h = F.concat(frame, F.transform(words, lambda w: F.xxhash64(w)), frame)
    run = h
    for j in range(1, s):
        run = F.zip_with(run, F.slice(h, j + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))
    # zip_with pads the shorter side with nulls: drop the s - 1 incomplete runs at the end
    run = F.slice(run, 1, F.greatest(F.size(h) - F.lit(s - 1), F.lit(0)))
    return F.when(F.size(words) > 0, run).otherwise(F.array().cast("array<bigint>"))


def with_anchors(df: DataFrame, text: Column, out: str, k: int = K, s: int = S, keep: list[str] | None = None,
                 positions: bool = True) -> DataFrame:
    """Adds ``out: array<struct<pos int, hash int>>``, the closed syncmers of ``text`` in text order.

    ``pos`` is the word position of the anchor's first word (negative in the
    frame); without ``positions`` the array holds the hashes alone. The run hashes pass through a one-row generator, so that they are
    computed once and not again for each use.
    """
    if not 1 <= s < k:
        raise ValueError("need 1 <= s < k")
    cols = [F.col(f"`{c}`") for c in (keep if keep is not None else df.columns)]
    base = df.select(*cols, F.inline(F.array(F.struct(_runs(words_of(text), k, s).alias("_runs")))))
    inner = k - s + 1

    def at(i: Column, j: int) -> Column:
        return F.get(F.col("_runs"), i + F.lit(j))

    def closed(i: Column) -> Column:
        edge = F.least(at(i, 0), at(i, inner - 1))
        result = F.lit(True)
        for j in range(1, inner - 1):
            result = result & (edge <= at(i, j))
        return result

    starts = F.when(F.size("_runs") >= inner, F.sequence(F.lit(0), F.size("_runs") - F.lit(inner))).otherwise(
        F.array().cast("array<int>"))
    # a k-mer is fixed by its runs: s-word runs at steps of at most s words cover it
    cover = sorted({*range(0, inner, s), inner - 1})

    def anchor(i: Column) -> Column:
        h = F.hash(*[at(i, j) for j in cover])
        return F.struct((i - F.lit(k - 1)).alias("pos"), h.alias("hash")) if positions else h

    return base.select(*cols, F.transform(F.filter(starts, closed), anchor).alias(out))


def hashes(anchors: Column) -> Column:
    return anchors.getField("hash")


def fingerprint_text(hash_array: Column) -> Column:
    """Eight lower-case hex digits per anchor, in text order."""
    return F.lower(F.array_join(F.transform(
        hash_array, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the distinct hashes of two arrays."""
    na, nb = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    return F.when(na + nb == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) * 2.0 / (na + nb))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``(doc_id, anchors, fingerprint)``, one row per input row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), as_text(text).alias("text"))
    return with_anchors(rows, F.col("text"), "anchors", k, s, ["doc_id"]).select(
        "doc_id", "anchors", fingerprint_text(hashes(F.col("anchors"))).alias("fingerprint"))


def match_positions(left: Column, right: Column) -> Column:
    """Pairs ``(pos in left, pos in right)`` of equal anchors, for lining passages up."""
    pairs = F.transform(left, lambda a: F.transform(
        F.filter(right, lambda b: a["hash"] == b["hash"]),
        lambda b: F.struct(a["pos"].alias("left"), b["pos"].alias("right"))))
    return F.flatten(pairs)


# ------------------------------------------------------- edits with the next document
def _range_number(value: Column, bounds: list) -> Column:
    """Number of bounds not above ``value`` (null: 0), by a two-level search of literal arrays."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    coarse = F.array(*[F.lit(c[0]) for c in chunks])
    fine = F.array(*[F.array(*map(F.lit, c)) for c in chunks])

    def below(a: Column) -> Column:
        return F.size(F.filter(a, lambda b: b <= value))

    chunk = below(coarse)
    return F.when(value.isNull() | (chunk == 0), F.lit(0)).otherwise(
        (chunk - 1) * F.lit(step) + below(F.get(fine, chunk - 1)))


def _deal_in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs(doc_id, text)`` with ``_range``, a number that grows with the id, and ``_head``.

    Bounds (at most ``ranges`` numbers) are approximate quantiles of the ids, so
    ranges hold about equal counts. The first row of each range is repeated, marked ``_head``, in
    the range before (the very first in the last), where it closes the order.
    """
    value = F.col("doc_id")
    at = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = docs.agg(F.percentile_approx(value, at, 100 * ranges)).first()[0]
    number = _range_number(value, sorted(set(bounds or [])))
    dealt = docs.withColumn("_range", number)
    first = {r._range: r for r in dealt.groupBy("_range").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.when(value.isNull(), 1)).alias("nulls")).collect()}
    order = sorted(first)  # ranges that have rows
    if not order:
        return dealt.withColumn("_head", F.lit(False))
    before = [0] * (order[-1] + 1)  # of each range, the one before it that has rows (of the first, the last)
    for r, earlier in zip(order, [order[-1], *order[:-1]], strict=True):
        before[r] = earlier
    # only range 0 can hold null ids; they come first there
    ids = [r.doc_id for r in first.values() if not r.nulls]
    wanted = value.isin(ids) if ids else F.lit(False)
    if len(ids) < len(first):
        wanted = wanted | value.isNull()
    heads = dealt.where(wanted).groupBy("_range").agg(F.min(F.struct("doc_id", "text")).alias("r"))
    heads = heads.select("r.doc_id", "r.text", F.get(F.lit(before), F.col("_range")).alias("_range"),
                         F.lit(True).alias("_head"))
    return dealt.withColumn("_head", F.lit(False)).unionByName(heads)


def edit_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document's beginning.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``, one row per input row. The edited text has its last
    ``floor(n_chars / 2)`` code points replaced by as many of the next
    document's first. One shuffle moves each text and its hashes, once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), as_text(text).alias("text"))
    dealt = _deal_in_order(rows, 4 * shuffle_width(docs.sparkSession))
    own = with_anchors(dealt, F.col("text"), "h", k, s, positions=False)
    w = Window.partitionBy("_range").orderBy("_head", F.col("doc_id").asc_nulls_first(), "text")
    both = own.select("*", F.lead("text").over(w).alias("next_text"), F.lead("h").over(w).alias("next_h")).where(
        ~F.col("_head"))
    n, half = F.length("text"), F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "h", "next_h", edited.alias("edited"))
    done = with_anchors(both, F.col("edited"), "eh", k, s, positions=False)
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("h")).alias("fingerprint"), fingerprint_text(F.col("eh")).alias("edited_fingerprint"),
        likeness(F.col("h"), F.col("eh")).alias("near_edited"), likeness(F.col("h"), F.col("next_h")).alias("near_next"))
