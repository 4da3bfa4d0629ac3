"""The text operators against plain versions of themselves, and on edge rows."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinflow.llm import (
    components, credentials, decontaminate, language, licences, minhash, mixture, privacy,
    shards, tokens, vptree)
from clinflow.llm.queries import vocabulary

SCHEMA = "doc_id bigint, text string, lang string, source string, size int, shard string, row int"
COMMON = "the cat sat on a mat while seven dogs ran over green hills of old stone "


def make(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, src, 1, "x", 2) for i, t, lang, src in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    words = ["w%d" % i for i in range(300)]
    out = []
    for i in range(60):
        text = " ".join(rng.choice(words, rng.integers(1, 120)))
        out.append((i, text, "ab"[i % 2], "s%d" % (i % 4)))
    out += [(100, out[3][1], "a", "s0"), (101, out[3][1], "a", None), (102, None, None, None),
            (103, "", "a", "s1"), (104, "  \t\n", "b", "s1"), (105, "é ß 日本 😀", None, "s2"),
            (7, out[7][1], "b", "s3"), (None, "no id here", "a", "s0"),
            (106, COMMON * 4000, "a", "s0"),
            (107, "mail a.b@c.de, +49 (30) 1234567 token = 'abcDEF123456' AKIAABCDEFGHIJKL "
                  "4111 1111 1111 1111, 10.0.0.255 " + "0f" * 20, "a", "s2")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).repartition(3).cache()


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5)]
    found = components.connected_components(
        spark.createDataFrame(links + [(None, 3)], "a bigint, b bigint"))
    got = dict(found.collect())
    assert got == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# SimHash


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(
        "[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, bits):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_simhash_matches_all_pairs(docs, rows):
    found = Counter(tuple(r) for r in vptree.near_duplicates(docs).collect())
    values = [plain_simhash(t) for _, t, _, _ in rows]
    groups, least = plain_groups(values, 3), defaultdict(list)
    for g, r in zip(groups, rows):
        least[g] += [r[0]] if r[0] is not None else []
    expected = Counter(
        (r[0], v - (1 << 64) if v >> 63 else v, min(least[g], default=None))
        for r, v, g in zip(rows, values, groups))
    assert found == expected


@pytest.mark.parametrize("tile", [100_000, 40])
def test_tree_links_every_near_pair(spark, tile):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 5), replace=False))
            for b in base[:150]]
    hub = [int(base[0]) ^ 1 << i for i in range(64)] + [
        int(base[0]) ^ 1 << i ^ 1 << j for i in range(20) for j in range(i)]
    values = sorted({int(b) for b in base} | set(near) | set(hub))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = vptree.link_forest(
        spark.createDataFrame([(v,) for v in signed], "fp bigint"), 3, leaf_rows=8, tile_rows=tile)
    got = dict(components.connected_components(links).collect())
    groups = plain_groups(values, 3)
    least = {}
    for g, s in zip(groups, signed):
        least[g] = min(least.get(g, s), s)
    assert [got.get(s, s) for s in signed] == [least[g] for g in groups]


def test_near_dedup_keeps_one_of_each_group(docs):
    kept = vptree.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named))
    assert 3 in named and 100 not in named and 101 not in named
    assert ids.count(None) == 1


@pytest.fixture(scope="module")
def shared_ids(spark):
    """One id for different texts, near copies without an id, clashing columns."""
    rng = random.Random(8)
    text = [" ".join("%s%d" % (rng.choice("abcdef"), rng.randrange(500)) for _ in range(120)) for _ in range(6)]
    rows = [(1, text[0]), (1, text[1]), (2, text[1]), (None, text[2]), (None, text[2]), (None, text[3]),
            (9, text[3]), (3, text[4]), (3, text[4]), (4, None), (4, ""), (None, None), (5, text[5])]
    return text, spark.createDataFrame(
        [(i, t, 1, 2, 3, 4) for i, t in rows],
        "doc_id bigint, text string, `key` int, fp int, kept int, root int").repartition(3)


def test_near_dedup_judges_rows_not_ids(shared_ids):
    text, docs = shared_ids
    out = vptree.keep_first(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    empty = [r for r in got if not r[1]]
    assert len(empty) == 1 and empty[0][0] == 4
    assert [r for r in got if r[1]] == sorted(
        [(1, text[0]), (1, text[1]), (None, text[2]), (9, text[3]), (3, text[4]), (5, text[5])], key=repr)


def test_decontamination_judges_rows_not_ids(spark, shared_ids):
    text, docs = shared_ids
    bench = spark.createDataFrame(
        [(k, " ".join(text[n].split()[20:50])) for k, n in enumerate([1, 3])], "item_id bigint, text string")
    out = decontaminate.remove(docs, bench)
    assert out.columns == docs.columns
    key = lambda r: (r["doc_id"], r["text"])
    assert sorted(map(key, out.collect()), key=repr) == sorted(
        (key(r) for r in docs.collect() if r["text"] not in (text[1], text[3])), key=repr)
    assert decontaminate.remove(docs.limit(0), bench).count() == 0
    assert decontaminate.remove(docs, bench.limit(0)).count() == docs.count()


# Token files


def test_token_files_hold_what_the_tokenizer_says(spark, docs, rows):
    path = tokens.write_tokens(docs, vocabulary(), block_ids=500)
    whole = Tokenizer.from_file(vocabulary())
    expected, start = [], 0
    for i, text, _, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = tokens.read_index(spark, path).sort("start").collect()
    assert [tuple(r)[:4] for r in found] == expected
    one = tokens.read_document(spark, path, 5)
    assert len(one) == 1 and one[0].tolist() == [
        *whole.encode(rows[5][1], add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer_on_odd_texts():
    rng = np.random.default_rng(1)
    signs = list("aAbZ 'sStlrevmd09.-!?\n\t\r<|>éÉß²½µªİΣς中😀́̈\x85 \x1c\x0b_") + [
        "<|endoftext|>", "<|startoftext|>", "'re"]
    own, whole = tokens.Encoder(vocabulary()), Tokenizer.from_file(vocabulary())
    for _ in range(4000):
        text = "".join(rng.choice(signs, rng.integers(0, 14)))
        assert own.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_cuts_each_word_of_a_slice_once(monkeypatch):
    own, whole, seen = tokens.Encoder(vocabulary()), Tokenizer.from_file(vocabulary()), []
    cut = own.cut
    own.cut = lambda text: seen.append(text) or cut(text)
    rng = np.random.default_rng(2)
    signs = list("aAbZ 'sStl09.-!?\n<|>éÉß½İΣς中😀́\x85\0  ") + ["<|endoftext|>", "'re"]
    texts = ["skipped", "", None, " the  hills\nof 日本 ",
             *["the old hills é <|endoftext|> of stone \0 a\0b ÀÉ's"] * 500,
             *["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(500)], ""]
    for limit in (tokens.CACHE_WORDS, 5):
        monkeypatch.setattr(tokens, "CACHE_WORDS", limit)
        seen.clear()
        ids, ends = own.encode_all(pa.array(texts).slice(1))
        assert len(ends) == len(texts) and ends[0] == 0
        for text, a, b in zip(texts[1:], ends, ends[1:]):
            assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids
        distinct = {w for t in texts[1:] for w in (t or "").split(" ")}
        assert len(seen) == 1 and len(seen[0].split(" ")) == len(distinct)
    none = own.encode_all(pa.array([], pa.string()))
    assert none[0].size == 0 and none[1].tolist() == [0]


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    packed = tokens.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert np.array_equal(tokens.unpack(packed, bits, 0, 1001), ids)
    assert np.array_equal(tokens.unpack(packed, bits, 13, 77), ids[13:77])


# Shards and mixture


def test_shards_have_equal_bytes_and_gapless_slots(docs, rows):
    found = shards.assign(docs, 4, ranges=8).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    per, total, largest = defaultdict(list), 0, 0
    sums = Counter()
    for r in found:
        per[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
        total, largest = total + r["size"], max(largest, r["size"])
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert all(abs(sums[s] - total / 4) <= largest for s in range(4))


def test_shards_split_one_text_that_holds_most_rows(spark):
    same = make(spark, [(i, "same text", "a", "s") for i in range(900)] + [
        (1000 + i, "t%d" % i, "a", "s") for i in range(100)])
    found = shards.assign(same, 4, ranges=16)
    sums = [r[1] for r in found.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 4 and max(sums) - min(sums) <= 40


def plain_targets(sizes, weights, total):
    capped = set()
    while True:
        left = total - sum(2 * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped and sizes[i]]
        unit = left / sum(weights[i] for i in free) if free else 0
        over = [i for i in free if unit * weights[i] > 2 * sizes[i]]
        if not over:
            return [2 * sizes[i] if i in capped else unit * weights[i] if i in free else 0
                    for i in range(len(sizes))]
        capped |= set(over)


def test_mix_meets_targets_and_caps(docs, rows):
    found = mixture.mix(docs, block_words=16).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    aims = dict(zip(names, plain_targets(
        [sizes[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))],
        1.5 * sum(sizes.values()))))
    taken = Counter()
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(aims[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[n] - aims[n]) <= 17 for n in names)
    again = mixture.mix(docs.repartition(7), block_words=16).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(spark, n):
    steps = F.array(*[F.struct(F.lit(s["f"]).cast("bigint").alias("f"),
                               F.lit(s["s"]).cast("bigint").alias("s"))
                      for s in mixture.rounds(n, 5)])
    out = spark.range(n).select(mixture.permuted(F.col("id"), F.lit(n).cast("bigint"), steps))
    assert sorted(r[0] for r in out.collect()) == list(range(n))


def test_permutation_of_many_slots_does_not_overflow(spark):
    n = 100_000_000_000
    steps = F.array(*[F.struct(F.lit(s["f"]).cast("bigint").alias("f"),
                               F.lit(s["s"]).cast("bigint").alias("s"))
                      for s in mixture.rounds(n, 5)])
    at = (F.lit(n - 5_000).cast("bigint") + F.col("id")).cast("bigint")
    out = [r[0] for r in spark.range(5_000).select(
        mixture.permuted(at, F.lit(n).cast("bigint"), steps)).collect()]
    assert len(set(out)) == 5_000 and 0 <= min(out) and max(out) < n
    assert n * 0.4 < sum(out) / len(out) < n * 0.6
    big, f, shift = (1 << 46) - 3, mixture.PRIMES[0], 12_345
    v = [0, 1, big - 1, big // 2, 987_654_321_987]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v bigint").select("i", mixture.affine(
        F.col("v"), F.lit(f).cast("bigint"), F.lit(shift).cast("bigint"), F.lit(big).cast("bigint"))).collect()
    assert all(r[1] == (v[r[0]] * f + shift) % big for r in got)


@pytest.fixture(scope="module")
def crowd(spark):
    """Three sources and rows without one: a hot text, texts without words, repeated and missing ids."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))), None, s)
            for i, s in enumerate(rng.choice(["x", "x", "x", "y", "z", None]) for _ in range(600))]
    rows += [(1000 + i, "one hot text of seven words here", None, "x") for i in range(400)]
    rows += [(None, "no id here", None, "y")] * 3 + [(5, "second text with id five", None, "z")]
    rows += [(6, None, None, "y"), (8, "", None, "w")]
    return rows, make(spark, rows).select("doc_id", "text", "source")


def test_slots_draw_each_source_per_shard_and_hold_the_words_of_the_stream(spark, crowd):
    rows, docs = crowd
    per = 64
    found = mixture.mixed(docs, block_words=4, shard_slots=per).collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r)
    assert sorted(by_shard) == list(range(len(by_shard)))
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by_shard.values())
    assert all(len(by_shard[k]) == per for k in list(by_shard)[:-1] if k != max(by_shard))
    # The counts of a source vary between shards as a multinomial draw does.
    share = Counter(r["source"] for r in found)
    full = [v for k, v in by_shard.items() if len(v) == per]
    for name, n in share.items():
        p = n / len(found)
        counts = [sum(r["source"] == name for r in v) for v in full]
        mean = sum(counts) / len(counts)
        spread = sum((c - mean) ** 2 for c in counts) / max(1, len(counts) - 1)
        assert abs(mean - per * p) < 4 * math.sqrt(per * p * (1 - p) / len(full)) + 1
        assert 0.4 < spread / (per * p * (1 - p)) < 2
    # No block comes a third time before all have come twice, and parts are as long as the slot says.
    times = Counter((r["source"], r["block"]) for r in found)
    assert max(times.values()) <= 2
    words = {i: len(t.split()) for i, t, _, _ in rows if t and i is not None and i not in (5, 6)}
    for r in found:
        assert sum(p["words"] for p in r["parts"]) <= r["words"]
        assert all(p["words"] > 0 and p["first"] >= 0 for p in r["parts"])
        assert all(p["first"] + p["words"] <= words[p["doc_id"]]
                   for p in r["parts"] if p["doc_id"] in words)
    # What the documents are said to give is what the slots hold.
    held = Counter()
    for r in found:
        for p in r["parts"]:
            held[p["doc_id"]] += p["words"]
    taken = Counter()
    for r in mixture.mix(docs, block_words=4, shard_slots=per).collect():
        taken[r["doc_id"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert +taken == +held


def test_growing_tables_of_the_mix_are_not_broadcast(spark, crowd):
    plan = mixture.mix(crowd[1])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan and "SortMergeJoin" in plan


def test_repeated_documents_keep_their_columns_and_follow_the_mix(spark, crowd):
    rows, docs = crowd
    names = ["_id", "_copies", "_copy", "id", "tie", "copies", "kept", "row", "number"]
    wide = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    out = mixture.repeat(wide, block_words=4)
    assert out.columns == wide.columns
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    taken, size, here = Counter(), Counter(), Counter((i, t, s) for i, t, _, s in rows)
    texts = {(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): t for i, t, _, s in rows}
    for r in mixture.mix(docs, block_words=4).collect():
        key = (r["doc_id"], texts[r["doc_id"], r["source"], r["size"]], r["source"])
        taken[key] += r["taken"]
        size[key] += r["size"]
    for key, n in here.items():
        times = taken[key] / size[key] if size[key] else 0
        assert got[key] in (n * math.floor(times), n * (math.floor(times) + 1))
    assert not [k for k in got if not (k[1] or "").strip()] and (None, "no id here", "y") in here


# Fingerprints


def test_fingerprints_and_edited_texts(docs, rows):
    found = minhash.compare_with_next(docs).collect()
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(found) == len(order)
    by_id = {r["doc_id"]: r for r in found}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        if i != 7:  # the id that comes twice follows itself once
            assert by_id[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            assert by_id[i]["n_chars"] == len(text)
    assert by_id[100]["fingerprint"] == by_id[101]["fingerprint"] == by_id[3]["fingerprint"]


@pytest.mark.parametrize("tile", [512, 3])
def test_classes_equal_those_of_all_pairs(spark, tile):
    rng = np.random.default_rng(5)
    words = np.array(["w%d" % i for i in range(2000)])
    texts = [" ".join(rng.choice(words, 200)) for _ in range(40)]
    for base in range(3):  # chains that drift away from their start, and stars of near copies
        own = texts[base].split()
        for k in range(12):
            own[(k * 13) % 200] = "chain%d" % k
            texts.append(" ".join(own))
        own = texts[base + 10].split()
        texts += [" ".join([*own[:199 - k % 9], "end%d" % k]) for k in range(12)]
    shared = rng.choice(words, 120).tolist()  # half of the text is shared: alike, but not enough
    texts += [" ".join(shared + rng.choice(words, 60).tolist()) for _ in range(20)]
    texts += [texts[3], texts[3].upper(), "", None, " \t", "one two", "one  two", texts[45]]
    rows = [(i + 1, t, "a", "s") for i, t in enumerate(texts)]
    rows += [(None, texts[3], "a", "s"), (None, "alone", "a", "s"), (2, texts[2], "a", "s")]
    sets = []
    for _, t, _, _ in rows:
        own = (t or "").lower().split()
        sets.append({tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))} if own else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (len(a & b) >= 0.8 * len(a | b)) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    ids = defaultdict(list)
    for r, row in zip(root, rows):
        ids[r] += [row[0]] if row[0] is not None else []
    expected = Counter((row[0], min(ids[r], default=None)) for r, row in zip(root, rows))
    docs = make(spark, rows).repartition(3)
    classes = minhash.near_duplicates(docs, tile_rows=tile)
    assert Counter((r[0], r[2]) for r in classes.collect()) == expected
    found = minhash.compare_with_next(docs, classes).select("doc_id", "component_id")
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_open_buckets_join_what_their_hub_does_not():
    rng = np.random.default_rng(1)
    bases = [np.unique(rng.integers(0, 1 << 32, 100, dtype=np.uint32)) for _ in range(3)]
    sets = [np.unique(np.append(b[k:], np.uint32(k))) for b in bases for k in range(5)]
    found = minhash.forest(sets, np.arange(15), 0.8)
    assert len(found) == 12 and all(i // 5 == j // 5 for i, j in found)


def test_likeness_estimates_jaccard():
    words = ["a%d" % i for i in range(400)]
    one, two = " ".join(words), " ".join(words[:380] + ["b%d" % i for i in range(20)])
    a, b = map(minhash.shingle_hashes, (one, two))
    true = np.intersect1d(a, b).size / np.union1d(a, b).size
    assert abs(minhash.likeness(minhash.signature(a), minhash.signature(b)) - true) < 0.2


# Secrets and private data


def test_secret_spans(docs, rows):
    found = credentials.digest(credentials.scan(docs)).collect()
    assert len(found) == len(rows)
    row = next(r for r in found if r["doc_id"] == 107)
    text = rows[-1][1]
    spans = []
    m = re.search(r"token = '[A-Za-z0-9+/_.=-]+", text)
    spans.append(("assign", *m.span()))
    spans.append(("access", *re.search("AKIA[A-Z0-9]+", text).span()))
    spans.append(("hex", *re.search("[0-9a-f]{32,}", text).span()))
    spans.sort(key=lambda s: s[1])
    written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (1, 1, 1)


def test_many_matches_in_one_text_cost_no_square(spark):
    rng = random.Random(6)
    texts = ["".join(f"{'zé '[:rng.randrange(1, 4)]} {rng.randrange(16 ** 33):034x} 😀" for _ in range(n))
             for n in (1, 2, 3, 5, 10, 17, 20_000)]
    docs = make(spark, [(i, t, "a", "s") for i, t in enumerate(texts)])
    begin = time.perf_counter()
    got = {r["doc_id"]: [(s["start"], s["stop"], s["value"]) for s in r["base"]]
           for r in credentials.scan(docs).collect()}
    assert time.perf_counter() - begin < 20  # 26 s for the longest text alone when spans were copied per match
    for i, text in enumerate(texts):
        assert got[i] == [(*m.span(), m.group()) for m in re.finditer("[0-9a-f]{32,}", text)]


def test_copied_values_are_examples(spark):
    secret, example = "q9Xw83kfLm2Pz7", "exampleKEY123"
    rows = [(i, f"token={example}", "a", "s%d" % i) for i in range(5)]
    found = credentials.digest(credentials.scan(make(spark, [*rows, (9, f"api_key: {secret}", "a", "s")])))
    spans = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert "example:6:19" in spans[0] and spans[9] == "assign:0:23,live:9:23"


def test_values_in_many_repositories_of_one_owner_are_examples(spark):
    rows = [(i, "token=exampleKEY123", "a", "s") for i in range(12)]
    rows += [(50 + i, "token=q9Xw83kfLm2Pz7", "a", "s") for i in (0, 0, 1)]
    rows += [(60, "token=r8Yv72jgKn3Qx6", "a", "s")] * 20  # copies within one repository
    docs = make(spark, rows)
    for table in (docs, docs.drop("source")):
        found = credentials.digest(credentials.scan(table)).collect()
        assert Counter((r["doc_id"] // 10 if r["doc_id"] >= 50 else 0, r["spans"]) for r in found) == {
            (0, "assign:0:19,example:6:19"): 12, (5, "assign:0:20,live:6:20"): 3,
            (6, "assign:0:20,live:6:20"): 20}


def test_failing_match_is_consumed(spark):
    found = credentials.digest(credentials.scan(make(spark, [(1, "password: token = abcdefghijkl", "a", "s")])))
    assert found.first()["n_assign"] == 0


def test_private_spans(docs, rows):
    row = next(r for r in privacy.digest(privacy.scan(docs)).collect() if r["doc_id"] == 107)
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    assert "email:5:13" in row["spans"]


@pytest.mark.parametrize("text", [
    "a@b.c%d@e.f", "x@y a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "1.2.3.999 12.0.0.1x", "@@a@b.c",
    "+1 (20) 3-4.5 678901", "+1(23)45(67)89(01)2", "4111-1111 1111-1111", "a" * 300 + "@b.c"])
def test_private_patterns_equal_the_contract(text):
    local = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    expected = [("email", *m.span()) for m in re.finditer(local, text)]
    expected += [("ip", *m.span()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))]
    expected += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                 if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    got = [(s[3], s[0], s[1]) for s in privacy.find(text) if s[3] != "card"]
    assert sorted(got) == sorted(expected)


def test_terms_that_reveal_an_entity_are_marked(spark):
    rows = [(i, f"note {i} zebrafish keeper wrote x@y.org about {COMMON}", "a", "s") for i in range(6)]
    rows += [(100 + i, f"{COMMON} about note wrote {i}", "a", "s") for i in range(60)]
    found = privacy.scan(make(spark, rows)).where("doc_id = 0").first()
    terms = {s["value"] for s in found["spans"] if s["kind"] == "term"}
    assert "zebrafish" in terms and "about" not in terms
    assert "[email]" in privacy.sanitise(rows[0][1], [tuple(s) for s in found["spans"]])


# Languages and licences


def test_languages_are_told_apart_and_strangers_rejected(spark):
    rng = np.random.default_rng(3)
    makers = {"en": ["the", "and", "of", "with", "house", "think"],
              "de": ["der", "und", "nicht", "über", "zeit", "schön"]}
    rows = [(i, " ".join(rng.choice(makers[lang], 40)), lang, "s")
            for i in range(80) for lang in [("en", "de")[i % 2]]]
    model = language.train(make(spark, rows[:60]))
    found = language.classify(make(spark, rows[60:] + [
        (900, "你好世界" * 20, None, "s"), (901, None, None, "s"), (902, "12 34", None, "s")]), model)
    got = {r["doc_id"]: r for r in found.collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] and got[r[0]]["accepted"] for r in rows[60:])
    assert not got[900]["accepted"]
    assert got[901]["lang_pred"] == got[902]["lang_pred"] == "und"


def test_long_texts_of_no_known_language_are_rejected(spark):
    rng = np.random.default_rng(13)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def strange(n, alphabet):
        return " ".join("".join(rng.choice(alphabet, rng.integers(2, 9))) for _ in range(n))

    vocabularies = {lang: [strange(1, letters[own]) for _ in range(400)] for lang, own in {
        "en": slice(0, 18), "de": slice(8, 26)}.items()}
    rows = [(i, " ".join(rng.choice(vocabularies[lang], rng.integers(20, 600))), lang, "s")
            for i in range(200) for lang in [("en", "de")[i % 2]]]
    cyrillic, cjk = [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x6E00)]
    signs = [*letters, *map(str.upper, letters), *"0123456789"]
    odd = [(900 + k, strange(n, a), None, "s") for k, (n, a) in enumerate(
        (n, a) for n in (50, 200, 1000) for a in (letters, cyrillic, cjk, signs))]
    model = language.train(make(spark, rows[:160]))
    got = {r["doc_id"]: r for r in language.classify(make(spark, rows[160:] + odd), model).collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] and got[r[0]]["accepted"] for r in rows[160:])
    assert not [r[0] for r in odd if got[r[0]]["accepted"]]


def test_licence_notices(spark):
    texts = ["Released under the MIT License.", "das Haus mit dem Garten\nLicensed under CC BY-NC 4.0.",
             "She lost her driving license.", None, "", "All rights reserved. " + "word " * 500]
    found = licences.scan(make(spark, [(i, t, "a", "s") for i, t in enumerate(texts)])).collect()
    sure = {(r["doc_id"], r["paragraph"]): r["family"] for r in found if r["family"] != "unknown"}
    assert sure == {(0, 0): "mit", (1, 1): "cc", (5, 0): "proprietary"}


# Decontamination


def test_decontamination_finds_verbatim_and_paraphrased_items(spark):
    rng = np.random.default_rng(8)
    words = ["t%d" % i for i in range(3000)]
    items = [" ".join(rng.choice(words, 30)) for _ in range(40)]
    fill = lambda: " ".join(rng.choice(words, 200))
    rows = []
    for i, item in enumerate(items):
        own = item.upper() if i % 2 else " ".join(
            w for k, w in enumerate(item.split()) if k % 6)  # every sixth word is gone
        rows.append((i, f"{fill()} {own}. {fill()}", "a", "s"))
    rows += [(100 + i, fill(), "a", "s") for i in range(100)] + [(300, None, "a", "s"), (301, "", "a", "s")]
    bench = spark.createDataFrame(
        [(i, t, 1) for i, t in enumerate(items)] + [(None, "x y", 1), (77, None, 1)],
        "item_id bigint, text string, doc_id int")
    docs = make(spark, rows)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench, answer=0.4).collect()}
    assert len(found & {(i, i) for i in range(40)}) >= 38
    assert all(d < 100 for d, _ in found)
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_long_and_common_items_at_its_own_thresholds(spark):
    rng = np.random.default_rng(18)
    words, shared = ["t%d" % i for i in range(3000)], ["c%d" % i for i in range(40)]
    items = [" ".join([*rng.choice(words, (12, 30, 150)[i % 3]), *rng.choice(shared, 6)]) for i in range(60)]
    items += [" ".join(rng.choice(shared, 14, replace=False)) for _ in range(6)]  # words of many items
    fill = lambda n: " ".join(rng.choice(words, n))
    rows = [(i, f"{fill(100)} {t}. {fill(150)}", "a", "s") for i, t in enumerate(items)]
    rows += [(100 + i, " ".join(w if k % 6 else f"{w} well" for k, w in enumerate(t.split())), "a", "s")
             for i, t in enumerate(items)]
    rows += [(200 + i, " ".join([fill(200), *rng.choice(shared, 8), fill(50)]), "a", "s") for i in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(make(spark, rows), bench).collect()}
    assert found == {(d + i, i) for i in range(66) for d in (0, 100)}


def plain_matches(texts, index, cosine, common, answer):
    """All windows of all texts against all items, one place at a time; answers and longest common
    subsequences from their definitions."""
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
        return row[-1]

    items, out = index.items, {}
    for d, text in enumerate(texts):
        at = [(p, items.numbers[w]) for p, w in enumerate(decontaminate.split_words(text)) if w in items.numbers]
        for i, own in enumerate(items.terms):
            words, size = items.lengths[i], decontaminate.window_length(items.lengths[i])
            for first in sorted({p // 16 for p, _ in at}):
                vector = sum((index.terms[t] for p, t in at if first <= p // 16 < first + size), 0 * index.terms[0])
                like = float(vector @ index.vectors[i]) / max(float(np.linalg.norm(vector)), 1e-9)
                if like < cosine and index.vectors[i].any():
                    continue
                middle, reach = first * 16 + size * 8, words + size * 8
                place = [(p, t) for p, t in at if middle - reach <= p < middle + reach]
                parts = [place] if not items.plain[i] else [
                    [x for x in place if p <= x[0] < p + words] for p, t in place if t in own]
                for part in parts:
                    found = [t for _, t in part]
                    told = len(index.answers[i] & set(found)) / len(index.answers[i])
                    if told < answer or len(set(found) & set(own)) == 0:
                        continue
                    share = lcs(own, found) / len(own)
                    if share >= common:
                        best = (share, told, like)
                        out[d, items.ids[i]] = max(out.get((d, items.ids[i]), (0,)), best)
    return out


@pytest.fixture(scope="module")
def questions(spark):
    """Texts that hold items whole, thinned, cut in two far parts, in short and long surroundings."""
    rng = np.random.default_rng(28)
    words, shared = ["t%d" % i for i in range(900)], ["c%d" % i for i in range(12)]
    items = [" ".join([*rng.choice(words, (9, 25, 70)[i % 3]), *rng.choice(shared, 4)]) for i in range(18)]
    items += [" ".join(rng.choice(shared, 9, replace=False)) for _ in range(3)]
    fill = lambda n: " ".join(rng.choice(words + shared, n))
    texts = []
    for k, item in enumerate(items):
        own = item.split()
        texts += [item, f"{fill(20 + 9 * k)} {item} {fill(11 * k)}",
                  " ".join([fill(37), *[w for j, w in enumerate(own) if j % 4], fill(30)]),
                  " ".join([*own[:len(own) // 2], fill(120), *own[len(own) // 2:]]), fill(90)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return texts, bench, make(spark, [(i, t, "a", "s") for i, t in enumerate(texts)])


@pytest.mark.parametrize("cosine, tile", [(0.2, 8192), (0.6, 8192), (0.2, 2)])
def test_decontamination_equals_all_places_one_by_one(spark, questions, monkeypatch, cosine, tile):
    texts, bench, docs = questions
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", tile)
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", tile)
    items = decontaminate.read_items(bench)
    assert items.plain == [i > 17 for i in range(21)]
    index = decontaminate.build(decontaminate.term_places(docs, items.numbers), items)
    want = plain_matches(texts, index, cosine, 0.6, 0.6)
    part = decontaminate.term_places(docs.coalesce(1), items.numbers).toArrow().combine_chunks().to_batches()[0]
    got = {(part.column(0)[r].as_py(), i): (common, answer, like) for r, i, like, common, answer in index.search(
        part, cosine, 0.6, 0.6, [0])}
    assert len(want) > 50 and set(got) == set(want)
    for key, (common, answer, like) in got.items():
        assert (common, answer) == pytest.approx(want[key][:2]) and like == pytest.approx(want[key][2], abs=1e-4)


def test_cosine_decides_what_is_a_match(questions):
    texts, bench, docs = questions
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()}
    assert {(5 * i + k, i) for i in range(21) for k in (0, 1)} <= found
    closed = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench, cosine=2.0).collect()}
    assert {i for _, i in closed} <= {18, 19, 20}  # those without a vector


@pytest.mark.parametrize("apply", [
    lambda d: vptree.near_duplicates(d), lambda d: vptree.keep_first(d),
    lambda d: tokens.read_index(d.sparkSession, tokens.write_tokens(d, vocabulary())),
    lambda d: shards.assign(d), lambda d: mixture.mix(d), lambda d: mixture.repeat(d),
    lambda d: minhash.compare_with_next(d), lambda d: minhash.near_duplicates(d), lambda d: credentials.scan(d),
    lambda d: privacy.scan(d), lambda d: language.classify(d, language.train(d)),
    lambda d: licences.scan(d),
    lambda d: decontaminate.matches(d, d.selectExpr("doc_id item_id", "text")),
    lambda d: decontaminate.matches(d, d.sparkSession.createDataFrame([(1, "a b c")], "item_id int, text string")),
    lambda d: decontaminate.remove(d, d.sparkSession.createDataFrame([(1, "a b c")], "item_id int, text string"))])
def test_empty_tables(spark, apply):
    assert apply(make(spark, [])).count() == 0
