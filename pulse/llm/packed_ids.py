"""Token ids in fixed-width bit-packed files.

Documents are range-partitioned and sorted by id; each task encodes its texts
and writes one shard. Every id takes the fewest bits that hold the vocabulary, least
significant bit first. Layout of a shard, all numbers little-endian:

    blocks of packed ids, each padded to whole bytes
    index: u64 position of each block and of the blocks' end, i64 ids of documents (0 where null),
           u8 null marks, u64 start of each document's ids and their total
    end:   magic "PULSEID1", u32 bits, u32 ids a block, u64 documents, u64 ids, u64 index position

Any run of ids is found from the block positions and unpacked by numpy without
reading the rest. A shard is written under a name of its attempt and then renamed, so a
task that is run again, or twice, leaves one whole shard.
"""

from __future__ import annotations

import os
import struct
import uuid
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulse.llm import common, vocab
from pulse.session import shared_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
BLOCK_IDS = 8192

_MAGIC = b"PULSEID1"
_END = struct.Struct("<8sIIQQQ")


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits an id, least significant first; eight ids are ``bits`` bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    eights = -(-len(ids) // 8)
    v = np.zeros(eights * 8, dtype=np.uint64)
    v[: len(ids)] = ids
    v = v.reshape(eights, 8)
    out = np.zeros((eights, bits + 8), dtype=np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        field = v[:, k] << np.uint64(shift)
        for j in range((bits + shift + 7) // 8):
            out[:, byte + j] |= (field >> np.uint64(8 * j)).astype(np.uint8)
    return out[:, :bits].tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    eights = -(-count // 8)
    raw = np.zeros(eights * bits, dtype=np.uint8)
    raw[: len(data)] = np.frombuffer(data, dtype=np.uint8)[: eights * bits]
    raw = np.pad(raw.reshape(eights, bits), ((0, 0), (0, 8)))
    out = np.zeros((eights, 8), dtype=np.uint64)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        for j in range((bits + shift + 7) // 8):
            out[:, k] |= raw[:, byte + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (out[:, k] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:count].astype(np.uint32)


class ShardWriter:
    """Writes one shard; holds one block of ids, and 17 bytes a document and 8 a block for the index."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.blocks, self.starts = array("q"), array("q", [0])
        self.docs, self.nulls = array("q"), bytearray()
        self.rest = np.empty(0, dtype=np.uint32)
        self.at = 0

    def add(self, docs: list[int | None], lengths, ids: np.ndarray) -> None:
        self.docs.extend(d or 0 for d in docs)
        self.nulls.extend(d is None for d in docs)
        self.starts.frombytes((self.starts[-1] + np.cumsum(lengths, dtype=np.int64)).tobytes())
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) - len(ids) % self.block_ids
        for at in range(0, whole, self.block_ids):
            self._block(ids[at: at + self.block_ids])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        self.blocks.append(self.at)
        data = pack(ids, self.bits)
        self.sink.write(data)
        self.at += len(data)

    def _write_all(self, numbers, at_once: int = 1 << 17) -> None:
        kind = "u1" if isinstance(numbers, bytearray) else "<i8"
        for at in range(0, len(numbers), at_once):
            self.sink.write(np.array(numbers[at: at + at_once], dtype=kind).tobytes())

    def close(self) -> tuple[int, int]:
        """Write the index and the closing header; (documents, ids)."""
        if len(self.rest):
            self._block(self.rest)
        self.blocks.append(self.at)
        for numbers in (self.blocks, self.docs, self.nulls, self.starts):
            self._write_all(numbers)
        end = _END.pack(_MAGIC, self.bits, self.block_ids, len(self.docs), self.starts[-1], self.at)
        self.sink.write(end)  # at the end: a stream to an object store cannot go back
        return len(self.docs), self.starts[-1]


class ShardReader:
    """Random access to one shard."""

    def __init__(self, source):
        self.source = source
        source.seek(source.size() - _END.size)
        magic, self.bits, self.block_ids, n_docs, self.n_ids, index = _END.unpack(source.read(_END.size))
        if magic != _MAGIC:
            raise ValueError("not a shard of packed ids")
        n_blocks = -(-self.n_ids // self.block_ids)
        source.seek(index)
        self.blocks = np.frombuffer(source.read(8 * (n_blocks + 1)), dtype="<u8")
        docs = np.frombuffer(source.read(8 * n_docs), dtype="<i8")
        nulls = np.frombuffer(source.read(n_docs), dtype="u1").astype(bool)
        self.docs = [None if none else d for d, none in zip(docs.tolist(), nulls.tolist())]
        self.starts = np.frombuffer(source.read(8 * (n_docs + 1)), dtype="<u8").astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard, reading only their blocks."""
        if end <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        self.source.seek(int(self.blocks[first]))
        data = self.source.read(int(self.blocks[last + 1] - self.blocks[first]))
        base = first * self.block_ids
        if self.block_ids % 8 == 0:  # whole bytes a block: the blocks unpack in one go
            return unpack(data, self.bits, min((last + 1) * self.block_ids, self.n_ids) - base)[start - base: end - base]
        parts = []
        for b in range(first, last + 1):
            a, z = (int(self.blocks[x] - self.blocks[first]) for x in (b, b + 1))
            parts.append(unpack(data[a:z], self.bits, min(self.block_ids, self.n_ids - b * self.block_ids)))
        return np.concatenate(parts)[start - base: end - base]


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


class _TextIds:
    """Ids of texts by the tokenizers library with its defaults, memoised by piece as uint32 bytes.

    New pieces are encoded many to a text, with a special token between them that splits the
    text before anything else and marks where each piece's ids end.
    """

    _PIECES_A_TEXT = 512

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        special = sorted(i for i, t in added.items() if t.special)
        #: The library takes these out of a text before anything else, so texts that hold one are encoded whole.
        self.added = tuple(sorted(t.content for t in added.values()))
        self.mark_id = special[0] if special else None
        self.mark = self.tokenizer.id_to_token(self.mark_id) if special else None
        self.pieces = vocab.Memo(vocab.PIECE_ENTRIES)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def learn(self, pieces: list[str]) -> list[bytes]:
        # Odd texts, and pieces that could form a special token's string, are encoded as they are.
        alone = [p for p in pieces if not p or "<" in p or p[0] == vocab.MARK or self.mark is None]
        found = dict(zip(alone, self.whole(["".join(vocab.pieces_of(p)) for p in alone])))
        rest = [p for p in pieces if p not in found] if alone else pieces
        parts = [rest[at: at + self._PIECES_A_TEXT] for at in range(0, len(rest), self._PIECES_A_TEXT)]
        joined = [self.mark + "".join([p + self.mark for p in part]) for part in parts]
        for part, got in zip(parts, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(got.ids, dtype="<u4")
            data, ends = ids.tobytes(), (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            found.update(zip(part, [data[a + 4: z] for a, z in zip(ends, ends[1:])]))
        return [found[p] for p in pieces]

    def encode_batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id after it; start of each text's ids and their end)."""
        pieces, index, starts = vocab.numbered_pieces(texts, self.added)
        values = vocab.memoised(self.pieces, pieces, self.learn)
        values.append(np.array([end_id], dtype="<u4").tobytes())
        index = np.insert(index, starts[1:], len(values) - 1)
        return vocab.laid_out(values, index, starts + np.arange(len(starts)), 4)


def write_shards(docs: DataFrame, root: str, path: str = VOCABULARY, end_id: int = END_ID,
                 shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``) and write shards under ``root``, in ascending ``doc_id``
    order over the shards' names. Returns the checkpointed manifest: ``(shard, path, n_docs, n_ids,
    bits, start)``, one row a shard, ``start`` the ids before it. Null ids come first.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    shared = vocab.share_file(spark, path)
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()), ("bits", pa.int32())])
    store, folder = open_store(root)
    store.create_dir(folder, recursive=True)

    def run(batches):
        texts = vocab.once_per_worker("tokenizer", shared.value, _TextIds)
        bits = max(texts.vocabulary - 1, end_id, 1).bit_length()
        task = TaskContext.get()
        number = task.partitionId()
        fs, at = open_store(root)
        final = f"{at}/ids-{number:06d}.bin"
        own = f"{final}.{task.taskAttemptId()}"
        writer = None
        for batch in batches:
            for part in common.parts(batch):
                if writer is None:
                    sink = fs.open_output_stream(own)
                    writer = ShardWriter(sink, bits)
                ids, starts = texts.encode_batch(part.column("text"), end_id)
                writer.add(part.column("doc_id").to_pylist(), np.diff(starts), ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            sink.close()
            fs.move(own, final)
            yield common.out_batch(schema, [number], [f"{root}/ids-{number:06d}.bin"], [n_docs], [n_ids], [bits])

    # Equal ids are ordered, and told apart for the ranges, by their text's hash.
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))
    manifest = common.cut(ordered.mapInArrow(run, "shard int, path string, n_docs long, n_ids long, bits int"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # over one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_shards(manifest: DataFrame, per_read: int = 1 << 20) -> DataFrame:
    """``(doc_id, start, ids_le)``: of every document in the shards its first id's number
    over all shards and its ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids_le", pa.binary())])

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                fs, at = open_store(uri)
                with fs.open_input_file(at) as source:
                    shard = ShardReader(source)
                    starts = shard.starts
                    doc = 0
                    while doc < len(shard.docs):  # as many documents as fit a read, one at least
                        to = max(int(np.searchsorted(starts, starts[doc] + per_read, "right")) - 1, doc + 1)
                        ids = shard.ids(int(starts[doc]), int(starts[to])).astype("<u4")
                        cuts = (starts[doc: to + 1] - starts[doc]).tolist()
                        yield common.out_batch(
                            schema, shard.docs[doc:to], pa.array(base + starts[doc:to]),
                            [ids[a:z].tobytes() for a, z in zip(cuts, cuts[1:])])
                        doc = to

    # One read task a shard: a count given by hand is not coalesced however small the manifest is.
    spread = manifest.select("path", "start").repartition(max(manifest.count(), 1), "path")
    return spread.mapInArrow(run, "doc_id long, start long, ids_le binary")


def new_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/packed-ids-{uuid.uuid4().hex}"


def round_trip(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as packed shards in the shared folder, read them back, and return per document
    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` (with the end id) and
    ``ids_crc32``.

    Null and empty texts have only the end id. Repeated ids keep their rows, in the order of
    their texts' hashes; a null id comes before all others. An empty table writes no shard.
    """
    manifest = write_shards(docs, new_root(docs.sparkSession), path, end_id)
    return read_shards(manifest).select(
        "doc_id", "start", F.expr("cast(octet_length(ids_le) / 4 as long)").alias("n_tokens"),
        F.crc32("ids_le").alias("ids_crc32"))
