"""Personal data against a brute-force version over all texts."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from clinflow.llm import privacy
from clinflow.llm.spans import written

SCHEMA = "doc_id bigint, text string, row int, terms string, th string"


def make(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA).repartition(3)


def base(text):
    """The contract, with plain patterns."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email", m.group().lower()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip", m.group()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card", digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 9 <= len(digits) <= 15:
            out.append((m.start(), 3, m.end(), "phone", digits))
    return sorted(out)


def plain(rows, threshold=0.8, least=3):
    texts = {t for _, t in rows if t is not None}
    words = {t: set(re.findall(r"[^\W\d_]{3,}", t.lower())) for t in texts}
    of_entity, of_term, both = defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        for w in words[t]:
            of_term[w].add(t)
        for s in base(t):
            of_entity[s[3:]].add(t)
            for w in words[t]:
                both[s[3:], w].add(t)
    terms = {w for (e, w), ts in both.items() if len(ts) >= least and math.log2(
        len(ts) * len(texts) / (len(of_entity[e]) * len(of_term[w])))
        >= threshold * math.log2(len(texts) / len(of_entity[e]))}
    out = []
    for i, t in rows:
        own = base(t or "")
        more = [(m.start(), 4, m.end(), "term", "") for m in re.finditer(r"[^\W\d_]{3,}", t or "")
                if m.group().lower() in terms
                and not any(m.start() < s[2] and s[0] < m.end() for s in own)]
        shown = lambda ss: ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(ss))
        out.append((i, *[sum(s[3] == k for s in own) for k in privacy.KINDS],
                    hashlib.sha256(shown(own).encode()).hexdigest(), shown(own + more)))
    return sorted(out, key=repr)


def found(spark, rows):
    return sorted(map(tuple, privacy.digest(privacy.scan(make(spark, rows))).collect()), key=repr)


FILL = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def filler(rng, n):
    return " ".join(rng.choice(FILL) for _ in range(n))


def rows_with_a_secret():
    rng = random.Random(5)
    rows = [(i, f"Zebrafish keeper {filler(rng, 30 + i)} write to zoe@fish.org") for i in range(6)]
    rows += [(50, "only the zebrafish here, no address")]
    rows += [(100 + i, f"{filler(rng, 20)} word{'abc'[i % 3]} {i}") for i in range(60)]
    return rows


def test_places_of_one_start_are_ordered_by_kind(spark):
    for text in ("10.0.0.1@host.com", "4111111111111111@x.com", "+4111111111111111 x", "1.2.3.4.5 6"):
        assert [(s[3], s[0], s[1]) for s in privacy.find(text)] == [(s[3], s[0], s[2]) for s in base(text)]
    got = found(spark, [(1, "10.0.0.1@host.com"), (2, "4111111111111111@x.com")])
    assert [r[-1] for r in got] == ["email:0:17,ip:0:8", "email:0:22,card:0:16"]


def test_a_term_far_from_its_entity_and_without_it(spark):
    rows = rows_with_a_secret()
    got = {r[0]: r[-1] for r in found(spark, rows)}
    assert all(got[i].startswith("term:0:9,term:10:16") for i in range(6))
    assert got[50] == "term:9:18" and not any(got[100 + i] for i in range(60))


def test_scan_equals_brute_force(spark):
    rng = random.Random(7)
    entities = ["a.b@c.de", "10.0.0.255", "4111 1111 1111 1111", "+49 (30) 1234567", "10.1.1.1@host.com"]
    rows = rows_with_a_secret()
    for i in range(120):
        e = rng.choice(entities)
        name = f"name{'abcde'[entities.index(e)]}" + "x" * 3
        parts = [filler(rng, rng.randint(0, 9)), e, name if rng.random() < 0.8 else "other", filler(rng, 4)]
        rng.shuffle(parts)
        rows.append((200 + i, " ".join(parts)))
    rows += [rows[-1]] * 3 + [(None, rows[-2][1]), (900, None), (901, ""), (902, "a1@b.c " * 3000)]
    assert found(spark, rows) == plain(rows)


def test_words_that_only_pass_the_bit_map(spark, monkeypatch):
    monkeypatch.setattr(privacy, "BITS", 16)  # nearly every word and text passes
    rows = rows_with_a_secret()
    rows += rows[:3] + [(None, rows[8][1])]
    assert found(spark, rows) == plain(rows)


def test_sanitised_texts(spark):
    rows = rows_with_a_secret() + [(None, None), (7, "card 4111111111111111@x.com end")]
    got = {r["doc_id"]: r["text"] for r in privacy.sanitised(make(spark, rows)).collect()}
    assert got[0].startswith("[...] [...] ") and got[0].endswith(" to [email]")
    assert got[50] == "only the [...] here, no address" and got[None] is None
    assert got[7] == "card [email] end" and got[100] == rows[7][1]
    assert privacy.sanitised(make(spark, [])).count() == privacy.scan(make(spark, [])).count() == 0


@pytest.mark.parametrize("order", [("b", "a"), ("a", "b")])
def test_written_spans(spark, order):
    ranks = {"a": 0, "b": 1}
    spans = ", ".join(f"named_struct('start', 1L, 'stop', {9 - ranks[k]}L, 'rank', {ranks[k]}, 'kind', '{k}', "
                      "'value', 'v')" for k in order)
    from pyspark.sql import functions as F
    assert spark.sql(f"SELECT array({spans}) AS s").select(written(F.col("s"))).first()[0] == "a:1:9,b:1:8"
