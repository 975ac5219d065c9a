"""Held-out passages inside a corpus: MinHash containment search, verified by exact shingles."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from registra.session import busy, cut, shuffled, small_side

# Patterns that the engine's and Python's regular expressions read alike.
COMMENT = r"(?s)<!--.*?-->"
INLINE = r"(?i)</?(?:b|i|em|strong|u|s|wbr|sub|sup|small|big|mark|font|code)(?:\s[^<>]*)?/?>"
TAG = r"</?[A-Za-z!][^<>]*>"
ESCAPE = r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\U([0-9a-fA-F]{8})"
PERCENT = r"(?:%[0-9a-fA-F]{2})+"
BREAK = r"\\[nrt]"  # an escaped line end; before a small letter it may also be a backslash and a word
DOUBTFUL = r"\\[nrt](?=[a-z])"
UNSEEN = "[\u00ad\u034f\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]"
_UNSEEN = re.compile(UNSEEN)
_COMMENT, _INLINE, _TAG, _ESCAPE, _PERCENT, _BREAK, _DOUBTFUL = map(re.compile, (COMMENT, INLINE, TAG, ESCAPE, PERCENT, BREAK, DOUBTFUL))


@lru_cache(1)
def escaped(gap: int = 0x500) -> str:
    """Pattern of what only Python undoes: character escapes and text that may not be in composed form.

    The latter are marks, Hangul vowels and finals, and characters that composition replaces, found by
    rule in the Unicode data. Neighbours less than ``gap`` apart are made one range: few ranges are
    quick to test, and a text that passes through Python without need comes out the same.
    """
    runs: list[list[int]] = []
    for c in range(0x80, 0x30000):
        ch = chr(c)
        if not 0xD800 <= c < 0xE000 and (unicodedata.category(ch)[0] == "M" or 0x1161 <= c <= 0x11C2 or unicodedata.normalize("NFC", ch) != ch):
            if runs and c - runs[-1][1] < gap:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return r"[&\\" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs) + "]|%[0-9a-fA-F]{2}"


def _character(m: re.Match) -> str:
    code = int(m[1] or m[2] or m[3], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else " "


def _percent(m: re.Match) -> str:
    try:
        return bytes.fromhex(m[0].replace("%", "")).decode()
    except UnicodeDecodeError:
        return m[0]


def undress(text: str, breaks: bool = True) -> str:
    """Text without markup, character escapes and unseen characters, in composed form.

    An escaped line end before a small letter is a line end only with ``breaks``; else the backslash is
    read as a sign, as in a path.
    """
    if "\\" in text:
        text = (_BREAK if breaks else re.compile(r"\\[nrt](?![a-z])")).sub(" ", _ESCAPE.sub(_character, text))
    if "%" in text:
        text = _PERCENT.sub(_percent, text)
    for _ in range(2):
        if "<" in text:
            text = _TAG.sub(" ", _INLINE.sub("", _COMMENT.sub("", text)))
        if "&" not in text:
            break
        text = html.unescape(text)
    return unicodedata.normalize("NFC", _UNSEEN.sub("", text))


@F.pandas_udf(StringType())
def _undressed(texts: pd.Series) -> pd.Series:
    return texts.map(undress, na_action="ignore")


@F.pandas_udf(StringType())
def _undressed_otherwise(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: undress(t, False), na_action="ignore")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_w`` and ``_v``: the runs of letters and digits of the undressed text in lower case, and those of its other reading.

    Null has no words; ``_v`` is empty unless an escaped line end can be read in two ways. Markup and
    unseen characters go in the engine; only texts with character escapes or loose marks, the lesser
    part, pass through Python.
    """
    value = F.col(text)
    hard = F.col("_kind")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, COMMENT, ""), INLINE, ""), TAG, " ")
    plain = F.regexp_replace(F.when(value.contains("<"), bare).otherwise(value), UNSEEN, "")
    asked = df.withColumn("_kind", F.coalesce(value.rlike(escaped()), F.lit(False))).withColumns({"_hard": F.when(hard, value), "_doubt": F.when(hard & value.rlike(DOUBTFUL), value), "_plain": F.when(~hard, plain)})
    read = asked.withColumns({"_hard": _undressed("_hard"), "_doubt": _undressed_otherwise("_doubt")})
    return read.withColumns({"_w": _words(F.coalesce("_hard", "_plain")), "_v": F.when(F.col("_doubt").isNotNull(), _words(F.col("_doubt"))).otherwise(F.array().cast("array<string>"))}).drop("_kind", "_hard", "_doubt", "_plain")


def _runs(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; none if there are fewer words."""
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(F.array().cast("array<bigint>"))


def _signatures(shingles: Column, width: int) -> Column:
    """The MinHash of every window of ``width`` shingles, each once."""
    return F.when(
        F.size(shingles) >= width, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(shingles) - (width - 1)), lambda i: F.array_min(F.slice(shingles, i, width))))
    ).otherwise(F.array().cast("array<bigint>"))


def contained_passages(docs: DataFrame, doc_id: str, items: DataFrame, item_id: str, text: str = "text", least: int = 10, shingle: int = 5) -> DataFrame:
    """Documents that hold at least ``least`` consecutive words of an item: ``doc_id``, ``item_id``, ``share``.

    ``share`` is the share of the item's runs of ``least`` words that the document holds. Null, empty and
    shorter texts contain nothing; repeated rows give repeated rows; null ids are kept; other columns
    are left out. Where an escaped line end can be read in two ways, a run in either reading counts.

    Search: a shared passage may be a small part of both texts, so both are cut into overlapping parts
    of one size class: the windows of ``least`` words, each a set of ``least - shingle + 1`` shingles.
    Within that class containment is equality, hence one MinHash of a window collides for certain and
    the search loses nothing; neighbouring windows mostly share their MinHash, which leaves about two
    values in seven to compare. The items' signatures are broadcast only if counted to fit.
    Verification: texts with a candidate are read again and compared by exact runs of ``least`` words, equal
    texts once. The corpus is undressed once; a hot text meets the rest only in the last join, on one small side.
    """
    width = least - shingle + 1

    def signed(df: DataFrame, *keys: str) -> DataFrame:
        """The signatures of both readings; the shingles are columns of their own, so that they are made once."""
        shingled = df.select(*keys, _runs(F.col("_w"), shingle).alias("_s"), _runs(F.col("_v"), shingle).alias("_t"))
        return shingled.select(*keys, F.explode(F.concat(_signatures(F.col("_s"), width), _signatures(F.col("_t"), width))).alias("_sig"))

    item_words = cut(with_words(items.select(F.col(item_id).alias("_item"), F.col(text).alias("_text")), "_text").drop("_text"))
    probes = signed(item_words, "_item").distinct()
    item_runs = item_words.select("_item", F.array_distinct(_exact_runs(least)).alias("_runs")).filter(F.size("_runs") > 0)

    corpus = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).filter("_text is not null")
    own = F.md5(F.col("_text").cast("binary"))
    numbered = busy(corpus).withColumns({"_row": F.monotonically_increasing_id(), "_own": own})
    searched = signed(with_words(numbered, "_text"), "_row", "_doc", "_own")
    candidates = cut(searched.join(small_side(probes), "_sig").select("_row", "_doc", "_own", "_item").distinct())

    asked = candidates.select("_own", "_item").distinct()
    texts = corpus.withColumn("_own", own).join(small_side(asked.select("_own").distinct()), "_own", "left_semi").dropDuplicates(["_own"])
    held = with_words(texts, "_text").select("_own", _exact_runs(least).alias("_held"))
    both = held.join(shuffled(asked), "_own").join(small_side(item_runs, 10_000), "_item")
    shared = both.select("_own", "_item", (F.size(F.array_intersect("_runs", "_held")) / F.size("_runs")).alias("share")).filter("share > 0")
    found = candidates.join(small_side(cut(shared)), ["_own", "_item"])
    return found.select(F.col("_doc").alias(doc_id), F.col("_item").alias(item_id), "share")


def _exact_runs(size: int) -> Column:
    """All runs of ``size`` words of both readings as text."""
    return F.concat(_exact(F.col("_w"), size), _exact(F.col("_v"), size))


def _exact(words: Column, size: int) -> Column:
    """All runs of ``size`` words as text."""
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.array_join(F.slice(words, i, size), " "))).otherwise(F.array().cast("array<string>"))
