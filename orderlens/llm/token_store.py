"""Operator 1: token ids in binary shards, with a minimal perfect hash index from keys to offsets.

Documents are range-partitioned by key and sorted; each task packs consecutive documents into shards of bounded size. A
shard is one row of the store's Parquet files: the raw ids of its documents back to back, and beside them its index. The
index is a minimal perfect hash over the shard's keys in the manner of layered bit arrays: a key whose position in a
layer is its own sets a bit there, the others go to the next layer; the rank of the bit is the slot. A slot holds a
fingerprint, which answers keys that are not stored, and the place of the key's documents. A lookup is a few hashes,
one comparison and one slice, whatever the size of the shard. Spark's commit protocol writes the files, so a lost
executor or a repeated task leaves no half shard.

Null text counts as empty. Rows without a key are stored first, and rows with the same key lie side by side, ordered by
text; the index leads to the first of them and their number. Extra columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MASK, mix, partitions, slices
from .units import SLICE, Memo, cut_ids, encode_texts, joinable, punctuation

SHARD_IDS = 1 << 20
# Characters of a text that tell rows of one key apart when ranges are cut.
LEAD = 64
GAMMA = 2
LAYERS = 64
# Units that the tokenizer gets as one text.
JOINED = 64
NULL_HASH = 0x5BF03635D3E2A9C7

SHARD = (
    "part int, seq int, first_key long, last_key long, n_ids long, keys binary, nulls int, bits binary, "
    "fingerprints binary, places binary, counts binary, offsets binary, payload binary, width int"
)


@functools.cache
def _memo(tokenizer_file: str, literal: bool) -> tuple[Memo, np.ndarray | None]:
    """Encodes with the tokenizers library: units that may stand together as texts of many, the others one by one. Beside
    it the marks that units are cut at, where the file splits texts by the pattern of byte-level tokenizers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.encode_special_tokens = literal
    settings = json.loads(tokenizer.to_str())
    split = settings["pre_tokenizer"] or {}
    words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    marks = None
    if words and not settings["normalizer"]:
        marks = punctuation([token["content"] for token in settings["added_tokens"]])
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    # Byte-level vocabularies write each byte of a token as one character.
    lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        lengths[i] = len(token)

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(row.ids, np.int64) for row in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(units: list[bytes]) -> list[bytes]:
        together = [i for i, u in enumerate(units) if joinable(u)]
        alone = sorted(set(range(len(units))).difference(together))
        out = [b""] * len(units)
        for i, ids in zip(alone, ids_of([units[i].decode() for i in alone]), strict=True):
            out[i] = ids.astype("<u4").tobytes()
        runs = [together[a : a + JOINED] for a in range(0, len(together), JOINED)]
        for run, ids in zip(runs, ids_of([b"".join(units[i] for i in run).decode() for run in runs]), strict=True):
            for i, part in zip(run, cut_ids(ids, lengths[ids], [units[i] for i in run]), strict=True):
                out[i] = part
        return out

    return Memo(encoded), marks


@functools.cache
def id_width(tokenizer_file: str, end_id: int) -> int:
    """Bytes of a stored id: two where the vocabulary allows it."""
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(with_added_tokens=True), end_id + 1)
    return 2 if size <= 1 << 16 else 4


def key_hashes(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    return np.where(null, np.uint64(NULL_HASH), mix(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))


def _layer_seed(layer: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (layer + 1)) & MASK)


def _layer_places(hashes: np.ndarray, layer: int, size: int) -> np.ndarray:
    return (mix(hashes ^ _layer_seed(layer)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Layers of bits; the slot of a key is the number of bits set before its own."""

    layers: list[np.ndarray]

    def __post_init__(self):
        sizes = [len(x) for x in self.layers]
        self.base = np.concatenate(([0], np.cumsum(sizes)[:-1])) if sizes else np.zeros(0, np.int64)
        flat = np.concatenate(self.layers) if self.layers else np.zeros(0, bool)
        self.rank = np.concatenate(([0], np.cumsum(flat)))

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """``hashes`` must be distinct; the slots are 0 to n - 1."""
        layers = []
        rest = hashes
        while len(rest):
            if len(layers) == LAYERS:
                raise ValueError("keys with equal hashes")
            size = max(64, GAMMA * len(rest))
            at = _layer_places(rest, len(layers), size)
            alone = np.bincount(at, minlength=size) == 1
            layers.append(alone)
            rest = rest[~alone[at]]
        return cls(layers)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for some that are not stored; the fingerprint tells for the others."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for layer, bits in enumerate(self.layers):
            if not len(open_):
                break
            at = _layer_places(hashes[open_], layer, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.rank[self.base[layer] + at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.layers), *map(len, self.layers)], "<u4").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.layers)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        sizes = np.frombuffer(raw, "<u4", n, 4).tolist()
        at, layers = 4 + 4 * n, []
        for size in sizes:
            packed = -(-size // 8)
            layers.append(np.unpackbits(np.frombuffer(raw, np.uint8, packed, at), count=size).astype(bool))
            at += packed
        return cls(layers)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype("<u4")


def _shard(part: int, seq: int, keys: list, texts: list[bytes], width: int) -> dict:
    null = np.array([k is None for k in keys], bool)
    values = np.array([0 if k is None else k for k in keys], np.int64)
    new = np.ones(len(keys), bool)
    new[1:] = (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    runs = np.flatnonzero(new)
    hashes = key_hashes(values[runs], null[runs])
    index = PerfectHash.build(hashes)
    slots = index.slots(hashes)
    count = np.diff(np.append(runs, len(keys)))
    table = {name: np.zeros(len(runs), "<u4") for name in ("fingerprints", "places", "counts")}
    table["fingerprints"][slots], table["places"][slots], table["counts"][slots] = _fingerprints(hashes), runs, count
    lengths = np.array([len(t) // width for t in texts], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    known = [k for k in keys if k is not None]
    return {
        "part": part, "seq": seq, "first_key": known[0] if known else None, "last_key": known[-1] if known else None,
        "n_ids": int(offsets[-1]), "keys": values.astype("<i8").tobytes(), "nulls": int(null.sum()),
        "bits": index.to_bytes(), **{name: column.tobytes() for name, column in table.items()},
        "offsets": offsets.astype("<u8").tobytes(), "payload": b"".join(texts), "width": width,
    }


SHARD_ARROW = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()),
     ("n_ids", pa.int64()), ("keys", pa.binary()), ("nulls", pa.int32())]
    + [(n, pa.binary()) for n in ("bits", "fingerprints", "places", "counts", "offsets", "payload")]
    + [("width", pa.int32())]
)


def write(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, *, key: str = "doc_id", text: str = "text",
    literal: bool = False,
) -> None:
    """Writes the ids of every text, each followed by ``end_id``, in ascending key order to the store at ``path``.

    The names of the file's added tokens get their own ids, as the library does by default; ``literal`` encodes them as
    plain text. Such a name must hold no white space.

    Ranges are cut by key and the first ``LEAD`` characters of the text, which agrees with the order by key and text, so
    the rows of a key that very many rows share, null included, fill many partitions as far as their texts differ there.

    The tokenizer sees every distinct unit of a worker once; units begin at spaces, and where the file has the pattern of
    byte-level tokenizers also at marks after a word; the cut never falls inside a pre-token or an added token.
    """
    width = id_width(tokenizer_file, end_id)
    end = np.array([end_id], f"<u{width}").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        memo, marks = _memo(tokenizer_file, literal)
        seq, size, keys, rows = 0, 0, [], []
        for batch in batches:
            for start, stop, data, offsets in slices(batch, "text", SLICE):
                ids, at = encode_texts(data, offsets, memo, marks)
                raw = memoryview(ids.astype(f"<u{width}").tobytes())
                for i, key in enumerate(batch.column(0).slice(start, stop - start).to_pylist()):
                    row = bytes(raw[width * at[i] : width * at[i + 1]]) + end
                    if keys and size + len(row) > SHARD_IDS * width:
                        yield pa.RecordBatch.from_pylist([_shard(part, seq, keys, rows, width)], SHARD_ARROW)
                        seq, size, keys, rows = seq + 1, 0, [], []
                    keys.append(key)
                    rows.append(row)
                    size += len(row)
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, seq, keys, rows, width)], SHARD_ARROW)

    # Spark samples whole sort columns to cut ranges, so the text itself is none of them.
    first = F.col("key").asc_nulls_first()
    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(partitions(docs.sparkSession), first, F.left("text", F.lit(LEAD)).asc_nulls_first())
        .sortWithinPartitions(first, "text")
    )
    ordered.mapInArrow(pack, SHARD).write.option("compression", "zstd").parquet(path)


def _entries(row: dict, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the keys in a shard: the index of the key and the place of each of its documents."""
    hashes = key_hashes(keys, null)
    index = PerfectHash.from_bytes(row["bits"])
    slots = index.slots(hashes)
    fingerprints = np.frombuffer(row["fingerprints"], "<u4")
    found = np.flatnonzero(slots >= 0)
    found = found[fingerprints[slots[found]] == _fingerprints(hashes[found])]
    places = np.frombuffer(row["places"], "<u4")[slots[found]].astype(np.int64)
    counts = np.frombuffer(row["counts"], "<u4")[slots[found]].astype(np.int64)
    of = np.repeat(found, counts)
    within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of, np.repeat(places, counts) + within


def _wide(row: dict) -> np.ndarray:
    return np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")


def with_starts(shards: DataFrame) -> DataFrame:
    """The shards with ``base``, the number of ids in all shards before. One row per part is ordered in one task."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("shard_base"))
    bases = sizes.join(totals, "part").select("part", "seq", (F.col("part_base") + F.col("shard_base")).alias("base"))
    return bases


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every stored document, each fetched by its key through the index.

    ``start`` counts the ids of all documents before; the checksum runs over the ids as little-endian 32-bit integers.
    """
    shards = read(spark, path)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = np.frombuffer(row["keys"], "<i8")
                null = np.arange(len(keys)) < row["nulls"]
                first = np.ones(len(keys), bool)
                first[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
                of, places = _entries(row, keys[first], null[first])
                offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
                ids = memoryview(_wide(row).tobytes())
                begin, end = offsets[places], offsets[places + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[first][of], mask=null[first][of]),
                        pa.array(np.full(len(of), row["part"], np.int32)),
                        pa.array(np.full(len(of), row["seq"], np.int32)),
                        pa.array(begin),
                        pa.array(end - begin),
                        pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begin, end, strict=True)], pa.int64()),
                    ],
                    names=["key", "part", "seq", "at", "n_tokens", "ids_crc32"],
                )

    found = shards.select("part", "seq", "keys", "nulls", "bits", "fingerprints", "places", "counts", "offsets", "payload", "width")
    rows = found.mapInArrow(fetch, "key long, part int, seq int, at long, n_tokens long, ids_crc32 long")
    return rows.join(with_starts(shards.select("part", "seq", "n_ids")), ["part", "seq"]).select(
        "key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(store: DataFrame, keys: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """key, ids for each distinct non-null key of ``keys`` that is stored, once per document with that key.

    Keys meet the shards whose range holds them; each shard gets its keys once and answers them from its index.
    """
    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
    spans = store.select("part", "seq", "first_key", "last_key").where("first_key is not null")
    parts = spans.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
    ends = [(r.part, r.low, r.high) for r in parts.orderBy("part").collect()]  # one row per partition of the store
    lows = np.array([r[1] for r in ends], np.int64)
    highs = np.array([r[2] for r in ends], np.int64)
    numbers = np.array([r[0] for r in ends], np.int64)

    def parts_of(values: pa.Array) -> pa.Array:
        v = values.to_numpy(zero_copy_only=False)
        first, last = np.searchsorted(highs, v, "left"), np.searchsorted(lows, v, "right")
        return pa.array([numbers[a:b].tolist() for a, b in zip(first, last, strict=True)], pa.list_(pa.int32()))

    def column() -> Column:
        return F.explode(F.arrow_udf(parts_of, "array<int>")(F.col("key")))

    placed = wanted.select("key", column().alias("part")).join(spans, "part").where("key between first_key and last_key")
    asked = placed.groupBy("part", "seq").agg(F.collect_list("key").alias("wanted"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                asked_keys = np.array(row["wanted"], np.int64)
                of, places = _entries(row, asked_keys, np.zeros(len(asked_keys), bool))
                offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
                ids = _wide(row)
                out = [ids[offsets[p] : offsets[p + 1]].tolist() for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked_keys[of]), pa.array(out, pa.list_(pa.int64()))], names=["key", "ids"]
                )

    return store.join(asked, ["part", "seq"]).mapInArrow(answer, "key long, ids array<long>")
