"""Byte-pair encoding of whole corpora in the engine's own expressions.

Words are byte arrays, which the engine can hash, compare and concatenate without Python. The rank map is a
literal: an array of small maps, chosen by a checksum of the piece, so that a look-up compares about three
keys. Only the driver reads the vocabulary file.
"""

from __future__ import annotations

import base64
import json
import unicodedata
import zlib
from collections.abc import Callable
from functools import lru_cache

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

from registra.session import busy, cut, shuffled, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The vocabulary's split pattern with @L, @N and @S for letters, numbers and white space, and the white space of Unicode.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[@L]+| ?[@N]+| ?[^@S@L@N]+|[@S]+(?![^@S])|[@S]+"
WHITE_SPACE = r"\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BUCKETS = 16384
NO_RANK = 2147483647


@lru_cache(4)
def _pieces(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(4)
def _rank_json(path: str) -> str:
    buckets: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for piece, rank in _pieces(path).items():
        buckets[zlib.crc32(piece) % BUCKETS].append({"p": base64.b64encode(piece).decode(), "r": rank})
    return json.dumps(buckets, separators=(",", ":"))


@lru_cache(4)
def _piece_json(path: str) -> str:
    by_rank = {rank: piece.hex() for piece, rank in _pieces(path).items()}
    return json.dumps([by_rank.get(i) for i in range(max(by_rank) + 1)], separators=(",", ":"))


def _ranges(points: list[int]) -> str:
    """The inside of a character class for sorted code points."""
    runs: list[list[int]] = []
    for c in points:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


@lru_cache(1)
def split_pattern() -> str:
    """The split pattern for this session's engine.

    Letters and numbers that the Unicode data at hand has and the engine's older data lack are found by
    asking the engine for all of them at once, and put into the pattern as ranges.
    """
    known = "".join(ch for ch in map(chr, [*range(0xD800), *range(0xE000, 0x40000)]) if unicodedata.category(ch)[0] in "LN")
    lacking = SparkSession.active().range(1).select(F.regexp_replace(F.lit(known), r"[\p{L}\p{N}]+", "")).first()[0]
    letters, numbers = ([ord(c) for c in lacking if unicodedata.category(c)[0] == kind] for kind in "LN")
    return SPLIT.replace("@L", r"\p{L}" + _ranges(letters)).replace("@N", r"\p{N}" + _ranges(numbers)).replace("@S", WHITE_SPACE)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` in the plan once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


class BytePairs:
    """Encoder and decoder expressions for one vocabulary of base64 pieces and ranks."""

    def __init__(self, path: str = VOCABULARY) -> None:
        self.path = path

    @staticmethod
    def _literal(value: Column) -> Column:
        """A constant expression. In one block of bytes where the session lets its plan be reached: tasks then receive it as that and not as a hundred thousand objects."""
        spark = SparkSession.active()
        try:
            frame = spark.range(1).select(value)._jdf
            block = frame.queryExecution().executedPlan().executeCollect()[0].copy().getArray(0)
            jvm = spark._jvm.org.apache.spark.sql
            return ClassicColumn(jvm.classic.ExpressionUtils.column(jvm.catalyst.expressions.Literal(block, frame.schema().apply(0).dataType())))
        except (AttributeError, TypeError, Py4JError):
            return value

    @property
    def _ranks(self) -> Column:
        buckets = F.from_json(F.lit(_rank_json(self.path)), "array<array<struct<p:binary,r:int>>>")
        return self._literal(F.transform(buckets, F.map_from_entries))

    @staticmethod
    def _rank(ranks: Column, piece: Column) -> Column:
        return F.get(ranks, F.pmod(F.crc32(piece), F.lit(BUCKETS)).cast("int"))[piece]

    def ranks(self, pieces: Column) -> Column:
        """The id of each piece (bytes) of an array, or null."""
        return bound(self._ranks, lambda m: F.transform(pieces, lambda w: self._rank(m, w)))

    def merge(self, word: Column) -> Column:
        """Ids of one word of two or more bytes: the pair of least rank is merged, leftmost first, until none is left.

        The fold carries the pieces and the ranks of neighbours; a merge looks up two ranks anew.
        """
        return bound(self._ranks, lambda m: self._merge(m, word))

    def _merge(self, m: Column, word: Column) -> Column:
        def rank(piece: Column) -> Column:
            return F.coalesce(self._rank(m, piece), F.lit(NO_RANK))

        def step(state: Column, _: Column) -> Column:
            p, r = state["p"], state["r"]
            none = F.slice(r, 1, 0)
            over = F.struct(p.alias("p"), none.alias("r"))  # without ranks the steps that are left cost nothing

            def merged(at: Column, joined: Column) -> Column:
                before = F.when(at > 1, F.array(rank(F.concat(F.get(p, at - 2), joined)))).otherwise(none)
                behind = F.when(at + 1 < F.size(p), F.array(rank(F.concat(joined, F.get(p, at + 1))))).otherwise(none)
                pieces = F.concat(F.slice(p, F.lit(1), at - 1), F.array(joined), F.slice(p, at + 2, F.size(p)))
                nearby = F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), before, behind, F.slice(r, at + 2, F.size(r)))
                return F.struct(pieces.alias("p"), nearby.alias("r"))

            def at_least(least: Column) -> Column:
                spot = F.array_position(r, least).cast("int")
                found = bound(spot, lambda at: bound(F.concat(F.get(p, at - 1), F.get(p, at)), lambda joined: merged(at, joined)))
                return F.when(least < NO_RANK, found).otherwise(over)

            return bound(F.coalesce(F.array_min(r), F.lit(NO_RANK)), at_least)

        def fold(letters: Column) -> Column:
            ranks = F.transform(F.slice(letters, F.lit(1), F.size(letters) - 1), lambda c, i: rank(F.concat(c, F.get(letters, i + 1))))
            start = F.struct(letters.alias("p"), ranks.alias("r"))
            return F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(letters), F.lit(2))), start, step, lambda s: F.transform(s["p"], lambda w: self._rank(m, w)))

        return bound(F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(word, i, F.lit(1))), fold)

    def encode(self, df: DataFrame, key: str = "doc_id", text: str = "text", salts: int | None = None) -> DataFrame:
        """``key`` and ``ids`` (array of int) of each row, without special tokens or clean-up.

        Null and empty texts give an empty list. Repeated keys and rows each give a row, null keys too;
        other columns are left out. The texts are split once. A word that is a piece itself gets its id in
        place. The other words are encoded once per distinct word, and only those words travel; their ids
        come back by word and salt (a hash of the row), so a word in a third of all texts spreads. A single
        word of n bytes costs up to n times n steps.
        """
        salts = salts or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
        rows = busy(df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))).withColumn("_row", F.monotonically_increasing_id())
        words = F.transform(F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(split_pattern()), F.lit(0)), lambda w: w.cast("binary"))
        split = rows.select("_key", "_row", words.alias("_words")).withColumn("_ids", self.ranks(F.col("_words")))
        gaps = F.filter(F.when(F.size("_ids") > 0, F.sequence(F.lit(0), F.size("_ids") - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.get("_ids", i).isNull())
        lacking = F.transform(gaps, lambda i: F.struct(i.alias("at"), F.get("_words", i).alias("word")))
        split = cut(split.select("_key", "_row", F.transform("_ids", lambda i: F.coalesce(i, F.lit(-1))).alias("_known"), lacking.alias("_lacking")))
        unknown = split.select("_row", F.inline("_lacking")).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
        salted = cut(unknown.select("word", "_salt").distinct())
        encoded = spread(salted.select("word").distinct()).select("word", self.merge(F.col("word")).alias("ids"))
        filled = unknown.join(shuffled(salted.join(shuffled(encoded), "word")), ["word", "_salt"]).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("_fill"))
        joined = split.select("_key", "_row", "_known").join(shuffled(filled), "_row", "left").withColumn("_at", F.transform("_fill", lambda x: x["at"]))
        at, n = F.col("_at"), F.size("_fill")

        def part(j: Column) -> Column:
            begin = F.when(j == 0, F.lit(0)).otherwise(F.get(at, j - 1) + 1)
            end = F.when(j < n, F.get(at, j)).otherwise(F.size("_known"))
            return F.concat(F.slice("_known", begin + 1, end - begin), F.when(j < n, F.get("_fill", j)["ids"]).otherwise(F.slice("_known", 1, 0)))

        ids = F.when(F.col("_fill").isNull(), F.col("_known")).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), n), part)))
        return joined.select(F.col("_key").alias(key), ids.alias("ids"))

    def decode(self, ids: Column) -> Column:
        """The text of an array of ids; null ids and ids outside the vocabulary add nothing."""
        pieces = self._literal(F.from_json(F.lit(_piece_json(self.path)), "array<string>"))
        joined = bound(pieces, lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))
        return F.decode(joined, "UTF-8")
