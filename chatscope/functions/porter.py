"""Porter stemmer (Porter 1980, "An algorithm for suffix stripping"), written from the paper.

Two variants: the paper's, and the extended one that the public ROUGE package
uses through NLTK (irregular forms, ``ies``/``ied`` of four letters, ``y`` only after a
consonant, ``bli``/``fulli``/``logi``, two-letter vowel-consonant stems); the extended
one is the default. Applied to tokens longer than three characters, as ROUGE
does with stemming on. The Spark entry points dedupe tokens per Arrow batch before stemming, so
Python work is proportional to the distinct words of a batch.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOWELS = set("aeiou")


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of VC sequences in ``stem``."""
    n, i, L = 0, 0, len(stem)
    while i < L and _cons(stem, i):
        i += 1
    while i < L:
        while i < L and not _cons(stem, i):
            i += 1
        if i >= L:
            break
        while i < L and _cons(stem, i):
            i += 1
        n += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_c(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str, extended: bool = False) -> bool:
    if len(w) < 3:
        return extended and len(w) == 2 and not _cons(w, 0) and _cons(w, 1)
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


def _rule(w: str, pairs, cond) -> str:
    for suf, rep in pairs:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if cond(stem) else w
    return w


# Suffix tables of steps 2-4 as given in the paper.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize")


# Fixed values of the extended variant: words with a stem of their own, and step 2's changes.
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
             "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}
STEP2_EXTENDED = tuple(("bli", "ble") if r == ("abli", "able") else r for r in STEP2) + (("fulli", "ful"),)


def _step1ab(w: str, extended: bool) -> str:
    if extended and len(w) == 4 and w.endswith("ies"):
        w = w[:-1]
    elif w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    if extended and w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
        return w
    for suf in ("ed", "ing"):
        if w.endswith(suf) and _has_vowel(w[: -len(suf)]):
            w = w[: -len(suf)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_c(w) and w[-1] not in "lsz":
                return w[:-1]
            if _m(w) == 1 and _cvc(w, extended):
                return w + "e"
            return w
    return w


def _step1c(w: str, extended: bool) -> str:
    if not w.endswith("y"):
        return w
    rest = w[:-1]
    change = len(rest) > 1 and _cons(rest, len(rest) - 1) if extended else _has_vowel(rest)
    return rest + "i" if change else w


def _step2(w: str, extended: bool) -> str:
    if not extended:
        return _longest_rule(w, STEP2, lambda s: _m(s) > 0)
    if w.endswith("alli") and _m(w[:-4]) > 0:
        return _step2(w[:-2], extended)
    if w.endswith("logi"):
        return w[:-1] if _m(w[:-3]) > 0 else w
    return _longest_rule(w, STEP2_EXTENDED, lambda s: _m(s) > 0)


def _step4(w: str) -> str:
    # longest matching suffix decides; only that one may be removed
    best = None
    for suf in STEP4:
        if w.endswith(suf) and (best is None or len(suf) > len(best)):
            best = suf
    if best is None:
        return w
    stem = w[: -len(best)]
    if best == "ion":
        return stem if _m(stem) > 1 and stem and stem[-1] in "st" else w
    return stem if _m(stem) > 1 else w


def _step5(w: str, extended: bool) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        if _m(stem) > 1 or (_m(stem) == 1 and not _cvc(stem, extended)):
            w = stem
    if _m(w) > 1 and _double_c(w) and w.endswith("l"):
        w = w[:-1]
    return w


def _longest_rule(w: str, table, cond) -> str:
    best = None
    for suf, rep in table:
        if w.endswith(suf) and (best is None or len(suf) > len(best[0])):
            best = (suf, rep)
    if best is None:
        return w
    return _rule(w, (best,), cond)


@lru_cache(maxsize=1 << 16)
def stem(word: str, extended: bool = True) -> str:
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _step1c(_step1ab(word, extended), extended)
    w = _step2(w, extended)
    w = _longest_rule(w, STEP3, lambda s: _m(s) > 0)
    return _step5(_step4(w), extended)


def stem_token(tok: str) -> str:
    """ROUGE convention: only tokens longer than three characters are stemmed."""
    return stem(tok) if len(tok) > 3 else tok


@F.pandas_udf(T.StringType())
def stem_udf(words: pd.Series) -> pd.Series:
    uniq = pd.unique(words.dropna())
    table = {w: stem_token(w) for w in uniq}
    return words.map(table)


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_tokens_udf(tokens: pd.Series) -> pd.Series:
    """Stem every token of every array in the batch (one Python pass per distinct word)."""
    table: dict = {}
    out = []
    for arr in tokens:
        if arr is None:
            out.append(None)
            continue
        res = []
        for t in arr:
            s = table.get(t)
            if s is None:
                s = table[t] = stem_token(t)
            res.append(s)
        out.append(res)
    return pd.Series(out)
