"""Token ids in bit-packed block files.

The files are Parquet tables. ``blocks`` has one row per block: its range, its number in the range,
the ids it holds and ``payload``, every id in ``bits`` bits, most significant bit first, without
gaps. ``bits`` is the least width for the vocabulary. A block holds whole documents and is closed
when it has ``block_ids`` ids; the arrays ``doc_id`` and ``offset`` (one entry more than documents)
give each document's place, so one document is read without unpacking the others. Rows are written in
ascending doc_id order; within a range file by file, ranges in order of their number. Documents without
an id come last.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from clinflow.llm.common import parallel, pick, slices
from clinflow.llm.order import id_splitters, range_of
from clinflow.operators.storage import materialize, scratch_path

END_ID = 1
CACHE_WORDS = 800_000
#: Words that the pattern of the tokenizer cuts after nothing but lower-casing.
PLAIN = r"\A[!-~\t-\rÀ-ÖØ-öø-ÿ]*\z"

BLOCKS = ("range int, block int, bits int, n_ids bigint, doc_id array<bigint>, "
          "offset array<bigint>, payload binary")


def bit_width(vocabulary: int) -> int:
    """The least number of bits that holds every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    wide = np.ascontiguousarray(ids, dtype=">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits:].reshape(-1)).tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, reading only the bytes that hold them."""
    first = start * bits // 8
    raw = np.frombuffer(payload, np.uint8, -(-stop * bits // 8) - first, first)
    flat = np.unpackbits(raw)[start * bits - first * 8:][:(stop - start) * bits]
    wide = np.zeros((stop - start, 32), dtype=np.uint8)
    wide[:, 32 - bits:] = flat.reshape(-1, bits)
    return np.packbits(wide, axis=1).reshape(-1).view(">u4").astype(np.uint32)


class Encoder:
    """Whole-text encoding that remembers the ids of words.

    The tokenizer drops white space and never joins what it separates, so a text's ids are those of
    its words in order. Texts come in slices, and Arrow numbers the distinct words of a slice: only these
    are encoded, and the ids of every occurrence are gathered by number. Plain words (printable ASCII and
    Latin letters) are cut together with the tokenizer's own pattern, and the pieces go to its model; any
    other word goes through the whole tokenizer. Pieces and other words are remembered up to
    ``CACHE_WORDS`` each and then forgotten together, which bounds memory and changes no result. A
    tokenizer of another shape encodes every text as a whole.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_word = self._words_apart(spec)
        if self.by_word:
            split = spec["pre_tokenizer"]["pretokenizers"][0]
            #: Pieces of words joined by spaces, the spaces among them.
            self.cut = regex.compile(split["pattern"]["Regex"] + "| ").findall
            self.model = self.tokenizer.model
            spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            #: The byte letters of what plain pieces hold, sign by sign.
            self.spelled = {i: spell(chr(i))[0][0] for i in [*range(33, 127), *range(0xC0, 0x100)]}
            self.words: dict[str, bytes] = {}
            self.parts: dict[str, bytes] = {}

    @staticmethod
    def _words_apart(spec: dict) -> bool:
        first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (normal == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split"
                and first.get("behavior") == "Removed" and first.get("invert") is True
                and not spec.get("post_processor")
                and all(" " not in t["content"] for t in spec["added_tokens"]))

    def _part(self, piece: str) -> bytes:
        """A piece of a plain word, or the space between two."""
        if piece == " ":
            return self._keep(self.parts, piece, b"")
        spelled = piece if piece.isascii() else piece.translate(self.spelled)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return self._keep(self.parts, piece, struct.pack(f"<{len(ids)}I", *ids))

    def _word(self, word: str) -> bytes:
        """A word that is not plain."""
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return self._keep(self.words, word, np.array(ids, dtype="<u4").tobytes())

    @staticmethod
    def _keep(known: dict[str, bytes], key: str, ids: bytes) -> bytes:
        if len(known) >= CACHE_WORDS:
            known.clear()
        if len(key) < 100:
            known[key] = ids
        return ids

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and where each word's ids start and end."""
        odd = pc.or_(pc.invert(pc.match_substring_regex(words, PLAIN)), pc.match_substring(words, "<|"))
        others = iter([
            i if (i := self.words.get(w)) is not None else self._word(w)
            for w in words.filter(odd).to_pylist()])
        # A NUL, which no plain word has, holds the place of any other word.
        marked = pc.if_else(odd, "\0", words)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], marked), " ")
        pieces = self.cut(joined[0].as_py().lower())
        get, miss = self.parts.get, self._part
        found = [next(others) if p == "\0" else i if (i := get(p)) is not None else miss(p)
                 for p in pieces]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
        gaps = np.flatnonzero(
            pc.equal(pa.array(pieces, pa.string()), " ").to_numpy(zero_copy_only=False))
        return (np.frombuffer(b"".join(found), dtype="<u4"),
                np.concatenate([[0], ends[gaps], ends[-1:]]))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (NULL: empty) one after the other, and where each text's ids start and
        end: one place more than texts."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
            return (np.array([i for ids in found for i in ids], dtype="<u4"),
                    np.cumsum([0, *map(len, found)], dtype=np.int64))
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        ids, edges = self._distinct(words.dictionary)
        first, sizes = edges[:-1], np.diff(edges)
        at = words.indices.to_numpy()
        size = sizes[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(first[at] - ends[:-1], size)
        place += np.arange(place.size)
        word = split.offsets.to_numpy()
        return ids[place], ends[word - word[0]]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and file: tasks of a worker share the remembered words."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = 1 << 16,
    path: str | None = None,
) -> str:
    """Encode every text (NULL: empty), add ``end_id``, write the block files; returns their folder.

    ``tokenizer`` is the path of a vocabulary file that every executor has. Documents are dealt to
    ranges of doc_id whose bounds come from a size-weighted sample, so ranges hold about equal
    amounts of text. Repeated ids are ordered by their text. Very long texts give a longer block; a
    task never holds more than one block, one batch and the words of one slice of it. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    texts = pick(docs, doc_id="doc_id:bigint", text="text:string")
    sizes = texts.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    parts = parallel(docs)
    splitters = id_splitters(sizes, parts)
    bits = bit_width(max(end_id + 1, encoder(tokenizer).vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_all
        end = np.array([end_id], dtype="<u4")
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        offset = [0]
        place, block = None, 0

        def close() -> pa.RecordBatch:
            whole = np.concatenate(held)
            row = [place, block, bits, whole.size, list(ids), list(offset), pack(whole, bits)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (
                    pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                    pa.list_(pa.int64()), pa.binary()))],
                ["range", "block", "bits", "n_ids", "doc_id", "offset", "payload"])

        for batch in batches:
            for part in slices(batch, 2, 8 << 20):
                found, ends = encode(part.column(2))
                for at, doc_id, a, b in zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(),
                        ends.tolist(), ends[1:].tolist()):
                    if held and (at != place or offset[-1] >= block_ids):
                        yield close()
                        held, ids, offset = [], [], [0]
                        block = block + 1 if at == place else 0
                    elif at != place:
                        block = 0
                    place = at
                    held += [found[a:b], end]
                    ids.append(doc_id)
                    offset.append(offset[-1] + b - a + 1)
        if held:
            yield close()

    dealt = texts.select(range_of(splitters).alias("range"), "doc_id", "text").repartitionById(
        parts, "range")
    dealt = dealt.sortWithinPartitions("range", F.col("doc_id").asc_nulls_last(), "text")
    dealt.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: where its ids are and what they are worth, from the files alone.

    ``start`` counts the ids of all documents before it in file order; ``ids_crc32`` is the crc32 of the
    ids as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per block, without payloads; the running total needs two levels: blocks of a range, ranges.
    heads = blocks.select("range", "block", "n_ids")
    totals = heads.groupBy("range").agg(F.sum("n_ids").alias("n")).collect()
    before, running = {}, 0
    for r in sorted(totals, key=lambda r: r[0]):
        before[r[0]] = running
        running += r[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block, bits, ids, offset, payload in zip(
                    *[batch.column(i).to_pylist() for i in range(5)], batch.column(5)):
                raw = payload.as_py()
                whole = unpack(raw, bits, 0, offset[-1]).astype("<u4").tobytes()
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([at] * n, pa.int32()), pa.array([block] * n, pa.int32()),
                    pa.array(ids, pa.int64()), pa.array(offset[:-1], pa.int64()),
                    pa.array(np.diff(offset)),
                    pa.array([zlib.crc32(whole[4 * a:4 * b]) for a, b in zip(offset, offset[1:])],
                             pa.int64())],
                    ["range", "block", "doc_id", "offset", "n_tokens", "ids_crc32"])

    found = blocks.select("range", "block", "bits", "doc_id", "offset", "payload").mapInArrow(
        run, "range int, block int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")

    order = Window.partitionBy("range").orderBy("block")
    base = heads.select(
        "range", "block",
        (F.sum("n_ids").over(order) - F.col("n_ids")
         + F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]),
                        F.col("range")).cast("bigint")).alias("base")) if before else heads.select(
        "range", "block", F.lit(0).cast("bigint").alias("base"))
    base = materialize(base, "block_starts")
    return found.join(base, ["range", "block"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
        "range", "block", "offset")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (one array for each row with that id), unpacked alone."""
    rows = spark.read.schema(BLOCKS).parquet(path).where(
        F.array_contains("doc_id", F.lit(doc_id).cast("bigint"))).sort("range", "block").collect()
    return [
        unpack(r["payload"], r["bits"], r["offset"][i], r["offset"][i + 1])
        for r in rows for i, d in enumerate(r["doc_id"]) if d == doc_id]
