"""Leaks against brute force, and stuffed pages against held-out labels."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from registra.llm.leaks import contained_passages, undress
from registra.llm.stuffed import FEATURES, fit_pages, page_features, phrases_elsewhere, stuffed_pages

WORDS = [f"w{i}" for i in range(400)]


def words(text):
    return re.findall(r"[^\W_]+", undress(text or "").lower())


def brute(docs, items, least=10):
    out = []
    for d, t, *_ in docs:
        w = words(t)
        held = {tuple(w[i : i + least]) for i in range(len(w) - least + 1)}
        for i, x in items:
            v = words(x)
            runs = {tuple(v[k : k + least]) for k in range(len(v) - least + 1)}
            if runs & held:
                out.append((d, i, len(runs & held) / len(runs)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("dressed", "plain"), [
    ("<p>Caf&eacute; <b>Bar</b><br/>x</p>", "café bar x"), ("a&amp;amp;b", "a&b"), ("Café", "café"), ("so­ft", "soft"), ("caf\\u00e9\\nbar", "café bar"), ("a%20b", "a b"), ("1 < 2 > 1", "1 < 2 > 1"), ("<!-- no -->yes", "yes"),
])
def test_undress(dressed, plain):
    assert " ".join(undress(dressed).lower().split()) == plain


def test_leaks_against_brute_force(spark, rows):
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.sample(WORDS, 40))) for i in range(6)] + [(6, "too short"), (7, None)]
    docs = [(None, None, "a"), (1, "", "a"), (2, "   ", "a")]
    for d in range(3, 60):
        item = items[d % 6][1].split()
        n, at = rnd.choice([9, 10, 11, 25]), rnd.randrange(0, 15)
        passage = " ".join(item[at : at + n]).upper().replace(" ", rnd.choice([" ", "\r\n> ", "<br/>", ", "]))
        docs.append((d, " ".join(rnd.choices(WORDS, k=rnd.choice([0, 3, 300]))) + " | " + passage, "a"))
    docs += [(3, docs[4][1], "a"), (None, docs[6][1], "a"), docs[5]]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, _own string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert rows(contained_passages(d, "doc_id", i, "item_id")) == brute(docs, items)
    assert rows(contained_passages(d.limit(0), "doc_id", i, "item_id")) == [] and rows(contained_passages(d, "doc_id", i.limit(0), "item_id")) == []


DRESSES = {
    "escapes": lambda w: w.replace(" ", "&nbsp;"), "markup": lambda w: "<p>" + w.replace(" ", "</p> <p class='x'>"), "inline": lambda w: "".join(f"<b>{c}</b>" for c in w), "comment": lambda w: w.replace(" ", " <!-- \n --> "),
    "unseen": lambda w: "\u200b".join(w), "apart": lambda w: "".join(c + "\u0301" if c == "e" else c for c in w), "breaks": lambda w: w.replace(" ", "\\n"), "percent": lambda w: w.replace(" ", "%20"), "path": lambda w: w.replace(" ", " C:\\new "),
}


def test_the_engine_reads_any_dress(spark, rows):
    """Markup and unseen characters in the engine, escapes in Python, escaped line ends in both readings."""
    item = "the permit lists each exit door and cafe \u00e9tage by name"
    accented = item.replace("e", "\u00e9")
    docs = [(i, f"x {dress(accented if name == 'apart' else item)} y") for i, (name, dress) in enumerate(DRESSES.items()) if name not in ("path", "apart")] + [(50, DRESSES["apart"](item)), (51, "see C:\\new permits and the \\notes"), (52, item.replace("permit", "pernit"))]
    items = [(1, item), (2, accented), (3, "a b c d e new permits and the notes")]
    d, i = (spark.createDataFrame(x, f"{n} bigint, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    got = {(r.doc_id, r.item_id) for r in contained_passages(d, "doc_id", i, "item_id").collect()}
    assert {(x, 1) for x in (0, 1, 2, 3, 4, 6, 7)} <= got and (50, 2) in got and not {51, 52} & {a for a, _ in got}
    both = [(9, "he said see c new permits and the notes today all right\\nthen we went")]
    either = [(4, "see c new permits and the notes today all right"), (5, "permits and the notes today all right then we went")]
    d, i = (spark.createDataFrame(x, f"{n} bigint, text string") for x, n in ((both, "doc_id"), (either, "item_id")))
    assert {r.item_id for r in contained_passages(d, "doc_id", i, "item_id").collect()} == {4, 5}


SENTENCES = ["The licence that you asked for is ready at the desk.", "We have been told to wait for the inspector and to call again.", "My neighbour said it was not his fault that the door had been left open.", "A copy of the letter will be sent to you before the end of the week."]


def pages(n=200, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            text = ", ".join(" ".join(rnd.sample(["cheap", "plumber", "harbour", "best", "online", "quote"], 3)) for _ in range(60))
        elif kind == 1:
            text = "\n".join(f"http://shop{rnd.randrange(999)}.example/p/{rnd.randrange(99)}" for _ in range(30))
        elif kind == 2:
            text = " ".join(rnd.choices(SENTENCES, k=8)) + f" See http://a{i}.example and #tag{i}."
        else:
            text = "Fees from this year on.\n" + "\n".join(f"{rnd.choice(WORDS)} {rnd.choice(WORDS)}: ${rnd.randrange(900)}" for _ in range(12)) + " " + " ".join(rnd.choices(SENTENCES, k=2))
        out.append((i, text, f"host{i % 5}", int(kind < 2)))
    return out


def test_stuffed_pages_on_held_out_labels(spark):
    data = pages() + [(None, None, None, 0), (900, "", "h", 0), (901, "x" * 100_000, None, 0)]
    docs = spark.createDataFrame([(*r[:3], "clash") for r in data], "doc_id bigint, text string, source string, score string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in data if r[0] is not None and r[0] % 3], "doc_id bigint, is_spam bigint")
    got = {r.doc_id: r.score > 0 for r in stuffed_pages(docs, "doc_id", labels).collect()}
    held_out = [r for r in data[:200] if r[0] % 3 == 0]
    assert sum(got[r[0]] == bool(r[3]) for r in held_out) >= 0.97 * len(held_out)
    assert set(got) == {r[0] for r in data} and not got[None] and not got[900]
    with pytest.warns(UserWarning, match="both kinds"):
        none = stuffed_pages(docs, "doc_id", labels.filter("is_spam = 1"))
    assert none.count() == len(data) and none.filter("score is not null").isEmpty()
    assert stuffed_pages(docs.limit(0), "doc_id", labels).count() == 0


def test_phrases_counted_over_hosts(spark):
    data = [(1, "a b c d e f", "x"), (2, "a b c d e z", "y"), (3, "q r s t u v", "x"), (4, "q r s t u v", "x"), (5, "k l m n", None), (6, "one two three four five", None), (7, "one two three four five", "x")]
    pages_ = page_features(spark.createDataFrame(data, "_row bigint, text string, host string"), "text")
    assert {r._row: len(r._phrases) for r in pages_.collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 0, 6: 1, 7: 1}
    assert {r._row: r._shared for r in phrases_elsewhere(pages_, "host").collect()} == {1: 1, 2: 1, 6: 1, 7: 1}


def test_features(spark):
    text = "Buy now, buy now. <b>Buy</b> now! http://a.example #sale"
    got = page_features(spark.createDataFrame([(text,), (None,), ("",)], "text string"), "text").collect()
    units = 8
    assert [round(got[0][f] * units, 6) for f in ("link_share", "tag_share", "end_share", "separator_share")] == [1, 1, 2, 1]
    assert [round(got[0][f], 4) for f in ("word_variety", "pair_variety", "phrase_variety")] == [round(2 / 6, 4), round(2 / 5, 4), 1.0]
    assert [tuple(r[f] for f in FEATURES[:6]) for r in got[1:]] == [(0.0, 0.0, 1.0, 1.0, 1.0, 0.0)] * 2
    assert got[1].end_share == got[1].separator_share == got[1].sentence_words == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="needs the driver's tables")
def test_held_out_labels_of_the_given_data(spark):
    """Fitted on two thirds of the labels, the score is right on at least 97 in a hundred of the others."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "page_labels"))
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    got = stuffed_pages(docs, "doc_id", labels.filter(~third)).join(labels.filter(third), "doc_id").select((F.col("score") > 0).alias("s"), (F.col("is_spam") == 1).alias("y")).collect()
    assert len(got) > 80 and sum(r.s == r.y for r in got) >= 0.97 * len(got)


def test_fit():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 8))
    y = (x[:, 0] - x[:, 3] > 0).astype(float)
    w = fit_pages(x, y).weights
    assert ((w[0] + x @ np.array(w[1:]) > 0) == (y > 0)).mean() > 0.97
    assert fit_pages(x, np.ones(400)) is None and fit_pages(x[:0], y[:0]) is None
