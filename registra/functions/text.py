"""Text and number expressions that stay inside code generation."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and signs that stand for "no value", compared without case and outer blanks.
NO_VALUE = (
    "", "?", "-", "--", "---", ".", "#n/a", "n/a", "n.a.", "na", "nan", "nil", "none", "null", "(null)",
    "<na>", "not applicable", "not available", "not provided", "tbd", "unknown",
)

# Fixed value: the shape of a Canadian postal code.
POSTAL_SHAPE = r"^[ABCEGHJ-NPRSTVXY]\d[ABCEGHJ-NPRSTV-Z] \d[ABCEGHJ-NPRSTV-Z]\d$"

# At most 200 digits before the point and two in the exponent, hence always finite.
DECIMAL_SHAPE = r"(?U)^\s*[+-]?([0-9]{1,200}(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\s*$"


BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def bare(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.btrim(c, F.lit(BLANKS))


def is_missing(c: Column) -> Column:
    """Null, blank, or a word or sign for "no value"; never null itself."""
    return F.coalesce(F.lower(bare(c)).isin(*NO_VALUE), F.lit(True))


def is_decimal(c: Column) -> Column:
    return c.rlike(DECIMAL_SHAPE)


def number(c: Column) -> Column:
    """Double of a decimal text; null for anything else (hex, ``1_000``, ``True``, ``2f``, infinities)."""
    return F.when(is_decimal(c), bare(c).try_cast("double"))


def whole_number(c: Column) -> Column:
    """Bigint of a text that is a decimal number without a fraction; else null."""
    value = F.when(is_decimal(c), bare(c).try_cast("decimal(38,6)"))
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def rounded_number(c: Column) -> Column:
    """Bigint of a decimal text, rounded half to even; else null."""
    return F.bround(number(c), 0).try_cast("bigint")


def rounded(c: Column, digits: int) -> Column:
    """So many digits, halves to the even neighbour, in binary arithmetic."""
    return F.rint(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


def squeeze(c: Column) -> Column:
    """Outer blanks off, inner white space to one blank, empty to null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", ""), F.lit(""))


def title(c: Column) -> Column:
    """Each letter after a non-letter in upper case, all others in lower case."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))), "")


def plain_key(c: Column) -> Column:
    """Upper case, everything but A-Z, 0-9 and blank deleted, blanks squeezed, empty to null."""
    return squeeze(F.regexp_replace(F.upper(c), "[^A-Z0-9 ]", ""))


def spaced_key(c: Column) -> Column:
    """Accents folded by decomposition, then upper case with every other sign made a blank; empty to null."""
    return squeeze(F.regexp_replace(F.upper(ascii_fold(c)), "[^A-Z0-9 ]", " "))


def _folding() -> tuple[str, str, dict[str, str]]:
    """What each character beyond ASCII keeps of its compatibility decomposition in ASCII, by rule and not by list.

    Characters that keep one ASCII character, those characters, and the ones that keep several.
    """
    source, target, longer = [], [], {}
    for cp in range(128, 0x20000):
        if not 0xD800 <= cp < 0xE000:
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if c.isascii())
            if len(plain) == 1:
                source.append(chr(cp))
                target.append(plain)
            elif plain:
                longer[chr(cp)] = plain
    return "".join(source), "".join(target), longer


FOLD_FROM, FOLD_TO, FOLD_LONGER = _folding()


def ranges(characters: str) -> str:
    """The inside of a character class for characters in order."""
    runs: list[list[int]] = []
    for c in map(ord, characters):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


def ascii_fold(c: Column) -> Column:
    """Letters with marks, wide and styled forms, ligatures and signs of several letters to plain ones; every other character beyond ASCII is dropped."""
    longer = F.from_json(F.lit(json.dumps(FOLD_LONGER)), "map<string,string>")
    spelt = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(r"^\p{ASCII}*$"), x).otherwise(F.coalesce(longer[x], x))), "")
    wide = F.when(c.rlike(f"[{ranges(''.join(FOLD_LONGER))}]"), spelt).otherwise(c)
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(F.regexp_replace(F.translate(wide, FOLD_FROM, FOLD_TO), r"[^\p{ASCII}]", ""))


def postal(c: Column) -> Column:
    """Upper case letters and digits; six of them as ``AAA BBB``; empty to null."""
    kept = F.nullif(F.regexp_replace(F.upper(c), "[^A-Z0-9]", ""), F.lit(""))
    return F.when(F.length(kept) == 6, F.concat(F.substring(kept, 1, 3), F.lit(" "), F.substring(kept, 4, 3))).otherwise(kept)


def postal_valid(c: Column) -> Column:
    return c.rlike(POSTAL_SHAPE)


def canonical(columns: list[Column]) -> Column:
    """One text for a row: lengths keep neighbours apart and null differs from empty."""
    return F.concat(*[F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns])
