"""Names in one consistent form: whole Arrow batches as numpy code points, no calls per row.

The text of a batch is copied once into an array of code points. Lookup tables say for every code point
what it expands to (full-width forms, ligatures, styled letters; nothing for unseen ones), whether it is
a blank, and which Latin letter a reader takes it for. Expansion is a gather at running offsets, words are
runs of letters numbered by a running sum, and marks are composed by a search in the sorted table of pairs.
"""

from __future__ import annotations

import unicodedata as U
from collections.abc import Iterator
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Letters of other alphabets (and some phonetic ones) and the Latin letters they are read as; Latin small capitals
# follow from their names.
LOOK_ALIKES = {
    "CYRILLIC": ("АВЕКМНОРСТХЅІЈҮЗԚԜаеорсухѕіјһӏԁԛԝүҽ", "ABEKMHOPCTXSIJY3QWaeopcyxsijhldqwye"),
    "GREEK": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυϲϳ", "ABEZHIKMNOPTYXaivopucj"),
    "ARMENIAN": ("օոսհցզյԼՕՍՏ", "onuhgqjLOUS"),
    "COPTIC": ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "BHIKMNOPCTYXopc"),
    "CHEROKEE": ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᎩᏃᎥ", "ABCDEGHJKLMPRSTVWYZi"),
    "LISU": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "CANADIAN": ("ᑌᐯᑭᒪᗪᗷᖴᕼᒍᗅᖇ᙭", "UVPLDBFHJARX"),
    "LATIN": ("ɑɡɩ", "agi"),
}
# Signs that are read as plainer ones.
SIGN_ALIKES = ("ʼʹ′″∕⁄∶꞉․‚٫⁎∗‐", "'''\"//::.,,**-")
DASHES_AND_QUOTES = "‐‑‒–—―‘’‚‛“”„‟«»‹›"
UNSEEN_LETTERS = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)
BLANK_LETTERS = (0x2800,)
SIZE = 0x110000
UNSEEN, BLANK, PLAINER, LATIN, TRUE, LOOK, LETTER = 1, 2, 4, 8, 16, 32, 64


def _expansion(ch: str) -> str | None:
    """What a compatibility character stands for, if a reader takes it for that; else None."""
    tag = U.decomposition(ch).partition(" ")[0]
    if not tag:
        return None
    if not tag.startswith("<"):
        return whole if (whole := U.normalize("NFC", ch)) != ch else None
    if tag in ("<wide>", "<narrow>", "<font>", "<small>") or (tag == "<compat>" and U.category(ch)[0] in "LN" and U.category(ch) != "No"):
        return U.normalize("NFKC", ch)
    return None


@lru_cache(1)
def tables() -> SimpleNamespace:
    """The lookup tables, built by rule from the Unicode data of the Python in use."""
    flags = np.zeros(SIZE, np.uint8)
    script = np.zeros(SIZE, np.uint16)
    look = np.arange(SIZE, dtype=np.uint32)
    ccc = np.zeros(SIZE, np.uint8)
    length = np.ones(SIZE, np.uint8)
    start = np.arange(SIZE, dtype=np.uint32)
    extra: list[int] = []
    names: dict[str, int] = {"LATIN": 1}
    pairs: dict[int, int] = {}
    alike = {a: (b, s) for s, (xs, ys) in LOOK_ALIKES.items() for a, b in zip(xs, ys, strict=True)}
    capitals = "LATIN LETTER SMALL CAPITAL "
    alike |= {ch: (name[-1], "LATIN") for ch in map(chr, range(0x250, 0xA800)) if (name := U.name(ch, "")).startswith(capitals) and len(name) == len(capitals) + 1}
    signs = dict(zip(*SIGN_ALIKES, strict=True))
    for cp in [*range(0x20000), *range(0xE0000, 0xE0200)]:
        ch = chr(cp)
        kind = U.category(ch)
        if kind in ("Cn", "Cs", "Co"):
            continue
        ccc[cp] = U.combining(ch)
        if kind == "Cf" or cp in UNSEEN_LETTERS or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or (kind == "Cc" and ch not in "\t\n\r\x0b\x0c\x85"):
            flags[cp], length[cp] = UNSEEN, 0
            continue
        if ch != " " and (kind in ("Zs", "Zl", "Zp", "Cc") or cp in BLANK_LETTERS):
            flags[cp], start[cp] = BLANK, 32
            continue
        whole = U.decomposition(ch)
        if whole and not whole.startswith("<") and " " in whole and U.normalize("NFC", ch) == ch:
            a, b = (int(x, 16) for x in whole.split())
            pairs[a << 21 | b] = cp
        if kind[0] in "LM":
            word = (U.name(ch, "?").split(" ") + ["?"])[0].split("-")[0]
            script[cp] = names.setdefault(word, len(names) + 1) if kind[0] == "L" else 0
            flags[cp] |= LETTER | (LATIN if word == "LATIN" or cp < 128 else TRUE if kind[0] == "L" else 0)
            base = U.normalize("NFD", ch)
            if base[0] in alike:
                mapped = U.normalize("NFC", alike[base[0]][0] + base[1:])
                if len(mapped) == 1 and (mapped.isascii() or U.name(mapped, "").startswith("LATIN")):
                    look[cp] = ord(mapped)
                    flags[cp] = LETTER | LOOK
        if (to := _expansion(ch)) is not None and ch not in alike:
            start[cp], length[cp] = SIZE + len(extra), len(to)
            extra += map(ord, to)
            plain = all(c.isascii() or U.name(c, "").startswith("LATIN") for c in to)
            flags[cp] = (flags[cp] & LETTER) | (PLAINER if plain and ch not in DASHES_AND_QUOTES else 0)
        elif ch in signs:
            start[cp] = ord(signs[ch])
            flags[cp] = 0 if ch in DASHES_AND_QUOTES else PLAINER
            if ch in DASHES_AND_QUOTES:
                start[cp] = cp
    for lv in range(0xAC00, 0xD7A4):
        i, t = divmod(lv - 0xAC00, 28)
        pairs[(lv - t) << 21 | (0x11A7 + t) if t else (0x1100 + i // 21) << 21 | (0x1161 + i % 21)] = lv
    keys = np.array(sorted(pairs), np.uint64)
    base, mark = np.zeros(SIZE, np.uint32), np.zeros(SIZE, np.uint32)
    for pair, cp in pairs.items():
        if not 0xAC00 <= cp < 0xD7A4:
            base[cp], mark[cp] = pair >> 21, pair & 0x1FFFFF
    composed = np.array([pairs[int(k)] for k in keys], np.uint32)
    data = np.concatenate([np.arange(SIZE, dtype=np.uint32), np.array(extra, np.uint32)])
    return SimpleNamespace(flags=flags, script=script, look=look, ccc=ccc, length=length, start=start, data=data, keys=keys, composed=composed, base=base, mark=mark)


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a string array, and the row of each."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]] if len(column) else np.empty(0, np.uint8)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.flatnonzero((raw & 0xC0) != 0x80)
    return points, (np.searchsorted(at - at[0], begins, "right") - 1).astype(np.int64) if len(begins) else np.empty(0, np.int64)


def _strings(points: np.ndarray, row: np.ndarray, column: pa.Array) -> pa.Array:
    """A string array of the rows' code points with ``column``'s nulls."""
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    sizes = np.bincount(row, width, minlength=len(column)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    valid = np.packbits(~np.asarray(column.is_null()), bitorder="little").tobytes() if column.null_count else None
    return pa.Array.from_buffers(pa.large_string(), len(column), [pa.py_buffer(valid) if valid else None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]).cast(pa.string())


def _sorted_marks(points: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The order that puts every run of marks into canonical order."""
    ccc = tables().ccc[points]
    return np.lexsort((ccc, np.cumsum((ccc == 0) | (np.diff(row, prepend=-1) != 0))))


def _compose(points: np.ndarray, row: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks in canonical order, then joined to their bases; rows where a Latin letter took a mark become odd.

    A composed letter before a mark is taken apart first, as the mark may belong below its own; its own
    marks come back without making the row odd.
    """
    t = tables()
    if not len(points):
        return points, row
    own = np.zeros(len(points), bool)
    while True:
        apart = np.flatnonzero((t.mark[points[:-1]] > 0) & (t.ccc[t.mark[points[:-1]]] > 0) & (t.ccc[points[1:]] > 0) & (row[1:] == row[:-1]))
        if not len(apart):
            break
        marked = t.mark[points[apart]]
        points = points.copy()
        points[apart] = t.base[points[apart]]
        points, row, own = np.insert(points, apart + 1, marked), np.insert(row, apart + 1, row[apart]), np.insert(own, apart + 1, True)
    marks = t.ccc[points]
    if np.any((marks[1:] > 0) & (marks[:-1] > marks[1:])):
        order = _sorted_marks(points, row)
        points, own = points[order], own[order]
    while len(points) > 1:
        cls = t.ccc[points]
        here = np.arange(len(points))
        base = np.maximum.accumulate(np.where(cls == 0, here, 0))
        prior = np.concatenate([[0], base[:-1]])
        base = np.where(cls == 0, prior, base)
        before = np.concatenate([[0], cls[:-1]])
        open_ = (base == here - 1) | ((cls > 0) & (before < cls) & (before > 0))
        key = points[base].astype(np.uint64) << np.uint64(21) | points.astype(np.uint64)
        spot = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
        hit = np.flatnonzero((t.keys[spot] == key) & open_ & (here > 0) & (row == row[base]) & (base < here))
        if not len(hit):
            break
        _, first = np.unique(base[hit], return_index=True)
        hit = hit[first]
        taken = np.isin(base[hit], hit)
        hit = hit[~taken]
        points = points.copy()
        points[base[hit]] = t.composed[spot[hit]]
        odd[row[hit[((t.flags[points[base[hit]]] & LATIN) > 0) & ~own[hit]]]] = True
        keep = np.ones(len(points), bool)
        keep[hit] = False
        points, row, own = points[keep], row[keep], own[keep]
    return points, row


def consistent(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each value in consistent form (null stays null), and whether it held a disguised character (null: false).

    Disguised is a character that is unseen, a blank other than the common one, a form of a plainer letter,
    digit or sign, an accent apart from its Latin letter, or a look-alike letter in a word that is not truly
    written in its alphabet. A word is that if it holds no Latin letter and one with no Latin look-alike; a
    word of look-alikes alone is so if the value has such a letter of the same alphabet elsewhere. Outer
    blanks go and inner ones become one; neither makes a value odd.
    """
    t = tables()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    points, row = _points(column)
    odd = np.zeros(len(column), bool)
    odd[row[(t.flags[points] & (UNSEEN | BLANK | PLAINER)) > 0]] = True
    sizes = t.length[points].astype(np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    points = t.data[np.repeat(t.start[points].astype(np.int64) - (ends - sizes), sizes) + np.arange(total)]
    row = np.repeat(row, sizes)
    flags = t.flags[points]
    letter = (flags & LETTER) > 0
    begins = letter & ~np.concatenate([[False], letter[:-1] & (row[1:] == row[:-1])]) if len(row) else letter
    word = np.cumsum(begins)
    n = int(word[-1]) + 1 if len(word) else 1
    latin, true = (np.bincount(word[(flags & bit) > 0], minlength=n) > 0 for bit in (LATIN, TRUE))
    scripts = row * 65536 + t.script[points]
    at_home = np.isin(scripts, np.unique(scripts[(flags & TRUE) > 0]))
    look = ((flags & LOOK) > 0) & ((t.script[points] == 1) | latin[word] | (~true[word] & ~at_home))
    odd[row[look]] = True
    points = np.where(look, t.look[points], points)
    points, row = _compose(points, row, odd)
    blank = points == 32
    if len(points):
        points, row = (x[~(blank & np.concatenate([[True], blank[:-1] | (row[1:] != row[:-1])]))] for x in (points, row))
        blank = points == 32
    if len(points):
        points, row = (x[~(blank & np.concatenate([row[1:] != row[:-1], [True]]))] for x in (points, row))
    return _strings(points, row, column), pa.array(odd)


def consistent_names(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys``, each of ``columns`` in consistent form, and ``<column>__odd``; other columns are left out.

    One pass without a shuffle. Null values stay null and are not odd; repeated rows stay repeated.
    """
    if clash := {f"{c}__odd" for c in columns} & {*keys, *columns}:
        raise ValueError(f"columns {sorted(clash)} are in use")
    chosen = df.select(*keys, *columns)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema] + [f"`{c}__odd` boolean" for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = {c: consistent(batch.column(c)) for c in columns}
            arrays = [done[n][0] if n in done else batch.column(n) for n in batch.schema.names] + [done[c][1] for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *(f"{c}__odd" for c in columns)])

    return chosen.mapInArrow(run, schema)
