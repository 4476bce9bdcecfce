"""Spelling variants against all pairs of words, and their odd inputs."""

import random
import re
import zlib
from collections import Counter

import pytest

from corpus_fixtures import make  # noqa: F401
from layercake.llm import spelling
from layercake.llm.common import table
from layercake.llm.queries import op11_spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, typo_every=None):
    total = Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return total


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(total, min_length, min_count):
    n = {w: k for w, k in total.items() if k >= min_count and len(w) >= min_length}
    # Words one edit apart share one of the words that a deletion leaves.
    left = {}
    for w in n:
        for short in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left.setdefault(short, []).append(w)
    near = {w: set() for w in n}
    for group in left.values():
        for a in group:
            near[a].update(b for b in group if b != a and one_edit(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("letters, min_length, min_count, limit, typo_every", [
    ("abé", 2, 1, 10**6, 7), ("abé", 2, 1, 5, 7), ("abcdÿ", 5, 1, 20, None), ("ab×", 5, 2, 10**6, 97),
])
def test_all_pairs_with_short_and_long_lists(make, letters, min_length, min_count, limit, typo_every):
    rng = random.Random(len(letters) + limit)
    word = lambda: "".join(rng.choice(letters + letters.upper()) for _ in range(rng.randint(1, 8)))
    rows = [(rng.choice([None, *range(50)]), " ".join(word() for _ in range(30))) for _ in range(60)]
    expected = brute(counted(rows, typo_every), min_length, min_count)
    assert sum(v[3] for v in expected.values()) > 100
    assert found(spelling.variants(make(rows), min_length, min_count, typo_every, limit)) == expected


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = op11_spelling_variants(spark, "/root/testdata/sf0.001")
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == brute(counted(rows, 97), 5, 3)


def test_odd_texts(make):
    long = "a" * 3000
    rows = [(1, None), (None, ""), (2, long), (2, long), (3, long + "b"), (4, "b" + long), (5, "naïve NAÏVE naive"),
            (6, "x" * 4), (7, "1 2 _ ā"), (None, "null null")]
    got = found(spelling.variants(make(rows), min_count=1))
    assert got == brute(counted(rows), 5, 1)
    # Only A-Z are lower-cased; ties between equally frequent near words go to the smallest.
    assert {"naïve", "naÏve", "naive"} <= set(got) and got[long][2:4] == (2, 2) and got["naive"][3] == 2
    assert found(spelling.variants(make([]))) == {}


def test_chains_lead_to_the_last_form(make):
    text = " ".join(["aaaaa"] * 1 + ["aaaab"] * 2 + ["aaabb"] * 4 + ["aabbb"] * 8 + ["abbbb"] * 16 + ["bbbbb"] * 32)
    got = found(spelling.variants(make([(1, text)]), min_count=1))
    assert got["aaaaa"] == ("aaaab", "bbbbb", 1, 1, 2) and got["bbbbb"] == (None, "bbbbb", 32, 1, None)
    # A form needs twice the count.
    assert found(spelling.variants(make([(1, "worda worda worda wordb wordb")]), min_count=1))["wordb"][:2] == (None, "wordb")


def test_columns_of_clashing_names_are_not_read(spark):
    docs = spark.createDataFrame(
        [(1, "words words words wordy wordy wordy", "x", 5, None, "y")], "doc_id int, text string, word string, n int, root string, stem string"
    )
    assert found(spelling.variants(docs)) == {"words": (None, "words", 3, 1, None), "wordy": (None, "wordy", 3, 1, None)}
