"""Personal data, and terms that reveal it.

Fixed patterns find the protected entities (e-mail, IP, card, phone). How much a term t tells about an
entity e is their pointwise mutual information over the distinct texts of the corpus, log2(n(e, t) * N /
(n(e) * n(t))), wherever in the text the two stand; the entity itself carries log2(N / n(e)). A term
with at least ``threshold`` of that amount reveals the entity as well as its name does. Every occurrence
of such a term is marked, in every text, beside the entity or without it, and ``sanitised`` removes it.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import pick, slices
from clinflow.llm.spans import of_kind, written
from clinflow.operators.storage import materialize

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Fixed values of the contract. The e-mail's local part must not be scanned anew from each of its
# characters, so its run is possessive and begins where no such character stands before; so are the
# digits of an IP address.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL_AT = re.compile(LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL = re.compile(r"(?<!" + LOCAL + r")" + EMAIL_AT.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT_RUN = re.compile(r"[0-9][0-9\x20.-]{6}")
TERMS = re.compile(r"[^\W\d_]{3,}")

SPANS = "array<struct<start:bigint,stop:bigint,rank:int,kind:string,value:string>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    if "@" not in text:
        return
    while True:
        # After a match the next one may begin in the middle of a run, right where that one ended.
        found = (EMAIL_AT.match(text, at) if at else None) or EMAIL.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, int, str, str]]:
    """(start, stop, rank, kind, value) of the base spans, sorted."""
    out = [(a, b, 0, "email", text[a:b].lower()) for a, b in emails(text)]
    if DIGIT_RUN.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split(".")):
                out.append((*m.span(), 1, "ip", m.group()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), 2, "card", digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if 9 <= len(digits) <= 15:
                out.append((*m.span(), 3, "phone", digits))
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def _texts(docs: DataFrame) -> DataFrame:
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string")
    return rows.select("doc_id", "text", F.xxhash64("text").alias("th"))


def entity_texts(docs: DataFrame) -> DataFrame:
    """Distinct (th, entity): which text, by its hash, mentions which entity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                th, entity = [], []
                for h, text in zip(part.column(0).to_pylist(), part.column(1)):
                    own = {f"{s[3]}:{s[4]}" for s in find(text.as_py() or "")}
                    th += [h] * len(own)
                    entity += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(th, pa.int64()), pa.array(entity, pa.string())], ["th", "entity"])

    return _texts(docs).select("th", "text").mapInArrow(
        run, "th bigint, entity string").distinct()


def terms_of(text: str) -> set[str]:
    return set(TERMS.findall(text.lower()))


def _pairs(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Distinct (entity, term, th): every term of a text with every entity of ``lists`` that it mentions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, text, entities in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                terms = list(terms_of(text))
                for entity in entities:
                    n = len(terms)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([entity] * n, pa.string()), pa.array(terms, pa.string()),
                         pa.array([h] * n, pa.int64())], ["entity", "term", "th"])

    return _texts(docs).select("th", "text").join(lists, "th").select("th", "text", "entities").mapInArrow(
        run, "entity string, term string, th bigint").distinct()


BITS = 1 << 20


def _marks(places: DataFrame) -> bytes:
    """A map of fixed size from a column of places below ``BITS``."""
    marks = bytearray(BITS // 8)
    for (b,) in places.distinct().collect():
        marks[b >> 3] |= 1 << (b & 7)
    return bytes(marks)


def bit_map(terms: DataFrame) -> bytes:
    """Lets through every term of the table and few others."""
    return _marks(terms.select(F.pmod(F.crc32("term"), F.lit(BITS))))


def _passes(marks: bytes, term: str) -> int:
    b = zlib.crc32(term.encode()) % (len(marks) * 8)
    return marks[b >> 3] >> (b & 7) & 1


def text_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): the number of distinct texts with each of the given terms.

    Texts that occur once are counted in their task, which sends a number per term. Texts whose hash
    occurs more often, or passes the bit map of those that do, send one row each with their terms packed;
    one row per hash is left, and these are counted and added. The exact terms are looked up after the count.
    """
    marks = bit_map(terms)
    texts = _texts(docs).where("text is not null").select("th", "text")
    copied = texts.groupBy("th").count().where("count > 1")
    copies = _marks(copied.select(F.pmod("th", F.lit(BITS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch, 1):
                th, packed = [], []
                for h, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = [t for t in terms_of(text) if _passes(marks, t)]
                    b = h % (len(copies) * 8)
                    if not copies[b >> 3] >> (b & 7) & 1:
                        once.update(own)
                    elif own:
                        th.append(h)
                        packed.append("\n".join(sorted(own)))
                yield _rows(th, packed, [None] * len(th), [None] * len(th))
            if len(once) > 200_000:
                yield _rows([None] * len(once), [None] * len(once), list(once), list(once.values()))
                once.clear()
        if once:
            yield _rows([None] * len(once), [None] * len(once), list(once), list(once.values()))

    sent = texts.mapInArrow(run, "th bigint, packed string, term string, n bigint")
    # Both kinds in one pass: a row with a term passes by itself, packed ones once per hash.
    keyed = sent.groupBy("th", "packed", "term").agg(F.sum("n").alias("n"))
    counted = keyed.select(
        F.explode(F.when(F.col("packed").isNull(), F.array("term")).otherwise(
            F.split("packed", "\n"))).alias("term"), F.coalesce("n", F.lit(1)).alias("n"))
    # An inner join: the planner would move a semi-join below the count, where there are far more rows.
    return counted.groupBy("term").agg(F.sum("n").alias("n_t")).join(terms.distinct(), "term")


def _rows(th: list, packed: list, term: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(th, pa.int64()), pa.array(packed, pa.string()), pa.array(term, pa.string()),
         pa.array(n, pa.int64())], ["th", "packed", "term", "n"])


def revealing(docs: DataFrame, threshold: float, least_texts: int) -> DataFrame:
    """(entity, term) pairs above the disclosure threshold.

    Counts are over distinct texts, so copies count once. Only entities of at least ``least_texts`` texts can
    have a pair of that many, so only their texts send terms. Counting (entity, term, text) before
    (entity, term) keeps an entity that very many texts mention from being one task's work.
    """
    each = materialize(entity_texts(docs), "entity_texts")
    often = materialize(each.groupBy("entity").agg(F.count("*").alias("n_e")).where(
        F.col("n_e") >= least_texts), "entities")
    lists = materialize(each.join(often.select("entity"), "entity", "left_semi").groupBy("th").agg(
        F.collect_list("entity").alias("entities")), "entity_lists")
    total = float(max(1, _texts(docs).where("text is not null").select("th").distinct().count()))
    rows = materialize(_pairs(docs, lists), "pair_texts")
    pairs = rows.groupBy("entity", "term").agg(F.count("*").alias("n_et")).where(
        F.col("n_et") >= least_texts)
    # A pair is over the threshold up to this number of texts with the term. Terms that stand in more of the
    # texts at hand, the common words, cannot come to less over all texts and are not counted there.
    most = F.col("n_et") * F.pow(F.lit(total) / F.col("n_e"), F.lit(1.0 - threshold)) * 1.000001
    seen = rows.select("term", "th").distinct().groupBy("term").agg(F.count("*").alias("n_seen"))
    pairs = materialize(
        pairs.join(often, "entity").join(seen, "term").where(F.col("n_seen") <= most), "pairs")
    counted = materialize(text_counts(docs, pairs.select("term").distinct()), "terms")
    told = F.log2(F.col("n_et") * F.lit(total) / (F.col("n_e") * F.col("n_t")))
    whole = F.log2(F.lit(total) / F.col("n_e"))
    return pairs.join(counted, "term").where(told >= threshold * whole).select("entity", "term")


def _marked(docs: DataFrame, terms: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, text, spans, terms): base spans, and the occurrences of words that pass the terms' bit map
    and lie in no base span. ``text`` is NULL unless asked for."""
    marks = bit_map(terms)
    span_type = pa.list_(pa.struct([
        ("start", pa.int64()), ("stop", pa.int64()), ("rank", pa.int32()),
        ("kind", pa.string()), ("value", pa.string())]))
    names = ("start", "stop", "rank", "kind", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                spans, near = [], []
                texts = part.column(1).to_pylist()
                for text in texts:
                    found = find(text or "")
                    spans.append([dict(zip(names, s)) for s in found])
                    wanted = {t for t in terms_of(text or "") if _passes(marks, t)}
                    starts = [s[0] for s in found]
                    reach = list(accumulate((s[1] for s in found), max))
                    near.append([
                        dict(zip(names, (*m.span(), len(KINDS), TERM, word)))
                        for m in (TERMS.finditer(text) if wanted else ())
                        if (word := m.group().lower()) in wanted and not (
                            (i := bisect_left(starts, m.end())) and reach[i - 1] > m.start())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts if with_text else [None] * len(texts), pa.string()),
                     pa.array(spans, span_type), pa.array(near, span_type)],
                    ["doc_id", "text", "spans", "terms"])

    return _texts(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id bigint, text string, spans {SPANS}, terms {SPANS}")


def scan(
    docs: DataFrame, threshold: float = 0.8, least_texts: int = 3, with_text: bool = False,
) -> DataFrame:
    """(doc_id, base, spans) for every row: arrays of (start, stop, rank, kind, value); and its text if
    wanted.

    ``base`` has the pattern matches, ``spans`` adds a ``term`` span for each occurrence of a term that
    reveals some entity, whether the text mentions the entity or not; a term needs ``least_texts`` distinct
    texts with the entity. NULL and empty texts have no spans; repeated rows come back as often as they came,
    rows without an id too. Ties of places are ordered by kind. An empty table gives no rows; other columns
    are not read.
    """
    pairs = materialize(revealing(docs, threshold, least_texts), "revealing")
    terms = materialize(pairs.select("term").distinct(), "revealing_terms")
    found = materialize(_marked(docs, terms, with_text).withColumn(
        "row", F.monotonically_increasing_id()), "marked")
    some = found.where(F.size("terms") > 0)
    # Words that only passed the bit map are looked up, not those that are wanted: few rows are joined.
    each = some.select("row", F.explode("terms.value").alias("term"))
    other = materialize(each.select("term").distinct().join(terms, "term", "left_anti"), "other_words")
    wrong = each.join(other, "term").groupBy("row").agg(F.collect_set("term").alias("wrong"))
    with_added = some.join(wrong, "row", "left").withColumn("all", F.concat(
        "spans", F.filter("terms", lambda t: ~F.coalesce(
            F.array_contains("wrong", t["value"]), F.lit(False)))))
    out = found.where(F.size("terms") == 0).withColumn("all", F.col("spans")).select(
        "doc_id", "text", "spans", "all").union(with_added.select("doc_id", "text", "spans", "all"))
    return out.select(
        "doc_id", *(["text"] if with_text else []), F.col("spans").alias("base"),
        F.col("all").alias("spans"))


def sanitise(text: str | None, spans: list) -> str | None:
    """The text with entities generalised to their kind and revealing terms removed. Of spans that overlap
    the first names the whole."""
    if text is None:
        return None
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s[0], s[2])):
        if s[0] >= at:
            out += [text[at:s[0]], f"[{s[3]}]" if s[3] != TERM else "[...]"]
        at = max(at, s[1])
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, threshold: float = 0.8, least_texts: int = 3) -> DataFrame:
    """(doc_id, text) of every row, with entities generalised and revealing terms removed; a NULL text
    stays NULL."""
    names = ("start", "stop", "rank", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                sanitise(text, [tuple(s[n] for n in names) for s in spans])
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    found = scan(docs, threshold, least_texts, with_text=True).select("doc_id", "text", "spans")
    return found.mapInArrow(run, "doc_id bigint, text string")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract from ``scan``'s spans."""
    return found.select(
        "doc_id", *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
