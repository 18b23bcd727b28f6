"""Byte-level BPE by backtracking over longest matches.

The bytes of a piece, read as Latin-1, go once through an Aho-Corasick automaton
of the vocabulary, which lists the tokens that start at each byte. The encoder
takes the longest token that is compatible with the one before it, falls back to
shorter ones, and steps back when none fits. Two tokens are compatible if the
merges, run on their joined bytes, give back exactly these two; a sequence whose
neighbours are all compatible is the one the merges produce. Compatibility is
memoised by pair, and a position that could not be continued is never entered again, so
the work is linear in the piece's length.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common, vocab

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Encodes and decodes by the ranks of one vocabulary file."""

    def __init__(self, data: bytes):
        self.ranks = vocab.read_ranks(data)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.length = [len(t) for t in self.bytes_of]
        self.sizes = np.array(self.length, dtype=np.int64)
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.fits: dict[int, bool] = {}
        self.pieces = vocab.Memo(vocab.PIECE_ENTRIES)  # piece: ids as bytes

    def merged(self, data: bytes) -> list[int]:
        """The merges as defined: join the lowest-ranked neighbours until none is a token."""
        parts = [data[i: i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], len(self.bytes_of)), i)
                           for i in range(len(parts) - 1))
            if rank == len(self.bytes_of):
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        key = left * len(self.bytes_of) + right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= vocab.PIECE_ENTRIES:
                self.fits.clear()
            both = self.bytes_of[left] + self.bytes_of[right]
            known = self.fits[key] = both not in self.ranks and self.merged(both) == [left, right]
        return known

    def encode_piece(self, piece: bytes) -> tuple:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        length, compatible = self.length, self.compatible
        starting: list[list[int]] = [[] for _ in piece]  # shortest first, as the scan meets their ends
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            starting[end + 1 - length[token]].append(token)
        out: list[int] = []
        tried: list[int] = []  # index of each taken token among those of its start
        stuck = bytearray(len(piece) + 1)
        at, k = 0, len(starting[0]) - 1
        while at < len(piece):
            choices = starting[at]
            while k >= 0:
                token = choices[k]
                end = at + length[token]
                if not stuck[end] and (not out or compatible(out[-1], token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                tried.append(k)
                at = end
                k = len(starting[at]) - 1 if at < len(piece) else 0
            elif out:
                stuck[at] = 1
                at -= length[out.pop()]
                k = tried.pop() - 1
            else:  # only in a vocabulary with tokens that its own merges cannot make
                return tuple(self.merged(piece))
        return tuple(out)

    def learn(self, pieces: list[str]) -> list[bytes]:
        return [np.array([i for q in vocab.pieces_of(p) for i in self.encode_piece(q.encode())], dtype="<u4").tobytes()
                for p in pieces]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text's ids and their end)."""
        pieces, index, starts = vocab.numbered_pieces(texts)
        return vocab.laid_out(vocab.memoised(self.pieces, pieces, self.learn), index, starts, 4)

    def encode(self, text: str) -> list[int]:
        return self.encode_batch(pa.array([text]))[0].tolist()

    def decode_batch(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The bytes that each run of ids stands for."""
        data, ends = vocab.gathered(self.all_bytes, self.sizes, ids.astype(np.int64), starts)
        return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [
            None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])

    def decode(self, ids) -> bytes:
        ids = np.array(ids, dtype=np.int64)
        return self.decode_batch(ids, np.array([0, len(ids)]))[0].as_py()


def _encoder(data: bytes) -> Encoder:
    return vocab.once_per_worker("bpe", data, Encoder)


_IDS = pa.list_(pa.int32())


def _id_lists(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, path: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>)`` for every row of ``docs`` (``doc_id``, ``text``), whole texts, no
    special tokens; with ``decoded`` also ``decoded``, the bytes the ids decode to.

    Null and empty texts have no ids. Repeated rows and null ids keep their rows;
    other columns are not read. ``path`` is the rank file.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    shared = vocab.share_file(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", _IDS)] + [("decoded", pa.binary())] * decoded)

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            for part in common.parts(batch):
                ids, starts = encoder.encode_batch(part.column("text"))
                columns = [part.column("doc_id"), _id_lists(ids, starts)]
                if decoded:
                    columns.append(encoder.decode_batch(ids, starts).cast(pa.binary()))
                yield common.out_batch(schema, *columns)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, decoded)``: the bytes of ``ids``; null ids decode to no bytes."""
    spark = encoded.sparkSession
    common.ship_package(spark)
    shared = vocab.share_file(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            lists = batch.column("ids")
            starts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            found = encoder.decode_batch(lists.flatten().to_numpy(), starts.astype(np.int64))
            yield common.out_batch(schema, batch.column("doc_id"), found.cast(pa.binary()))

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Count of ids, and SHA-256 of the decimal ids and of the decoded bytes."""
    return encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
