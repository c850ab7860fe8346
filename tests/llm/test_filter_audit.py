import random
import re
from itertools import permutations

import pytest

from periodica.llm.filter_audit import filter_audit, potentials, worths

DOCS = "doc_id long, text string, lang string, source string, part string, n int, mask string"
LABELS = "doc_id long, quality int, toxic int, text string"


def fails(doc, docs):
    """The filters that a document fails, read off their definitions."""
    text = doc[1] or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if set(text) & set("#$%&*|"):
        out.add("D")
    smaller = (o for o in docs if o[0] is not None and doc[0] is not None and o[0] < doc[0])
    if any((o[1] or "") == text for o in smaller):
        out.add("E")
    return out


def brute(docs, labels):
    """Every order applied to every document."""

    def labelled(doc, at):
        return any(x[0] is not None and x[0] == doc[0] and x[at] == 1 for x in labels)

    facts = [(d[2] or "", fails(d, docs), labelled(d, 1), labelled(d, 2)) for d in docs]
    out = {}
    for part in {f[0] for f in facts}:
        mine = [f for f in facts if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(name in f[1] for f in mine) - len(gone),
                    sum(f[1] == {name} for f in mine),
                    sum(f[2] for f in gone),
                    sum(f[3] for f in gone),
                ]
        for key, row in out.items():
            if key[0] == part:
                row.append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def compare(spark, docs, labels):
    wide = [(*d, "src", "x", 1, "y") for d in docs]
    rows = filter_audit(
        spark.createDataFrame(wide, DOCS),
        spark.createDataFrame([(*x, "t") for x in labels], LABELS),
    ).collect()
    got = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    assert got == brute(docs, labels)


def text(rng):
    pool = [f"w{i}" for i in range(rng.choice([20, 400]))]
    if rng.random() < 0.3:
        pool += ["ABC", "DEF"] * 30
    words = [rng.choice(pool) for _ in range(rng.choice([3, 99, 100, 150]))]
    if rng.random() < 0.3:
        words.append(rng.choice("#$%&*|"))
    return rng.choice([" ", "\t", "\x0b"]).join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_order(spark, seed):
    rng = random.Random(seed)
    texts = [text(rng) for _ in range(25)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(120)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)]
    compare(spark, docs, labels)


def test_odd_rows(spark):
    """Null ids and texts, repeated rows and labels, blanks that are none, a long text."""
    one = "a b " * 60
    docs = [
        (None, "x", "en"),
        (None, "x", "en"),
        (3, "x", None),
        (3, "x", None),
        (9, "x", "en"),
        (4, None, "de"),
        (5, "", "de"),
        (6, "   \n", "de"),
        (7, one, "fr"),
        (8, "Ä" * 40 + "\x1c", "fr"),
        (10, "word " * 300_000 + "#", "fr"),
        ((1 << 60) + 1, "x", "en"),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (9, None, 1), (77, 1, 1), (None, 1, 1), (10, 1, 1)]
    compare(spark, docs, labels)


def test_one_text_for_everyone(spark):
    docs = [(i, "Same TEXT", "en") for i in range(500)]
    compare(spark, docs, [(499, 1, 1), (0, 1, 0)])


def test_empty(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit(docs, labels).count() == 0
    compare(spark, [(1, "a", "en")], [])


def test_potential_of_a_known_game():
    """Shares of one document that two filters fail, and of one that a third fails alone."""
    import numpy as np

    worth = worths(np.array([0b00011, 0b00100]), np.array([1, 1]))
    scaled = potentials(worth)
    shares = [scaled[-1] - 5 * scaled[31 ^ 1 << i] for i in range(5)]
    assert shares == [60, 60, 120, 0, 0]
    assert sum(shares) == 120 * worth[-1]
