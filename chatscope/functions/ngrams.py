"""Tokenizers and n-gram builders for the text metrics (all native expressions).

* ``rouge_tokens``: lowercase, every run of characters outside ``[a-z0-9]`` is
  a separator (Lin 2004; the public rouge-score tokenizer).
* ``bleu13a_tokens``: the "13a" tokenizer of mteval / sacreBLEU (Post 2018).
* ``chrf_text``, ``chrf_chars``: characters with all whitespace removed (Popović 2015).

White space is Python's: what ``str.split()`` splits on, no-break and other
Unicode spaces included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatscope.functions.text import WS, chars, col_of

# Fixed values of the 13a tokenizer (mteval-v13a / sacreBLEU), applied in order.
BLEU13A_RULES = (
    (r"([{-~\[-` -&(-+:-@/])", " $1 "),   # punctuation and symbols
    (r"([^0-9])([\.,])", "$1 $2 "),        # period/comma unless preceded by a digit
    (r"([\.,])([^0-9])", " $1 $2"),        # period/comma unless followed by a digit
    (r"([0-9])(-)", "$1 $2 "),             # dash after a digit
)


def _split_ws(s: Column) -> Column:
    return F.filter(F.split(s, WS + "+"), lambda t: t != "")


def rouge_tokens(text: Column | str) -> Column:
    t = F.regexp_replace(F.lower(F.coalesce(col_of(text), F.lit(""))), "[^a-z0-9]+", " ")
    return F.filter(F.split(t, " "), lambda x: x != "")


def bleu13a_tokens(text: Column | str) -> Column:
    s = F.regexp_replace(F.coalesce(col_of(text), F.lit("")), WS + r"+\z", "")  # rstrip
    s = F.replace(s, F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    s = F.replace(s, F.lit("&quot;"), F.lit('"'))
    s = F.replace(s, F.lit("&amp;"), F.lit("&"))
    s = F.replace(s, F.lit("&lt;"), F.lit("<"))
    s = F.replace(s, F.lit("&gt;"), F.lit(">"))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in BLEU13A_RULES:
        s = F.regexp_replace(s, pat, rep)
    return _split_ws(s)


def chrf_text(text: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(col_of(text), F.lit("")), WS + "+", "")


def chrf_chars(text: Column | str) -> Column:
    return chars(chrf_text(text))
