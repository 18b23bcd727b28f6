"""Token counts of greedy longest-match pieces by a linear automaton.

The vocabulary is a trie over bytes. A node that cannot be continued pops the
pieces its bytes are known to be split into and moves to the node of the bytes
left over (its failure link); both are worked out once for every node, breadth
first, and of the pieces only their number is kept. Counting a word is then one
step a byte: no piece is built and no byte is read twice.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common, vocab

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


class Counter:
    """Numbers of greedy longest-match pieces, for a vocabulary with all single bytes."""

    def __init__(self, data: bytes):
        self.known = vocab.Memo(vocab.PIECE_ENTRIES)  # matches of the pattern: word pieces
        tokens = vocab.read_ranks(data)
        if any(bytes([b]) not in tokens for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes: some texts would have no pieces")
        step: dict[int, int] = {}  # node * 256 + byte -> node
        is_token = [False]
        for token in tokens:
            node = 0
            for byte in token:
                key = node * 256 + byte
                node = step.setdefault(key, len(is_token))
                if node == len(is_token):
                    is_token.append(False)
            is_token[node] = True
        fail, pops = [0] * len(is_token), [0] * len(is_token)
        layer = {key: child for key, child in step.items() if key < 256}
        below: dict[int, list[int]] = {}
        for key in step:
            below.setdefault(key >> 8, []).append(key)
        while layer:
            deeper = {}
            for key, child in layer.items():
                if is_token[child]:
                    pops[child] = 1  # the node's bytes are one piece; nothing is left over
                else:
                    parent, byte = key >> 8, key & 255
                    count, node = pops[parent], fail[parent]
                    while node * 256 + byte not in step:
                        count, node = count + pops[node], fail[node]
                    pops[child], fail[child] = count, step[node * 256 + byte]
                for k in below.get(child, ()):
                    deeper[k] = step[k]
            layer = deeper
        self.step, self.fail, self.pops = step, fail, pops

    def count_piece(self, data: bytes) -> int:
        step, fail, pops = self.step, self.fail, self.pops
        node = count = 0
        for byte in data:
            to = step.get(node * 256 + byte)
            while to is None:  # each turn gives up a piece for good, so turns never outnumber bytes
                count += pops[node]
                node = fail[node]
                to = step.get(node * 256 + byte)
            node = to
        while node:
            count += pops[node]
            node = fail[node]
        return count

    def learn(self, matches: list[str]) -> list[int]:
        return [sum([self.count_piece(q.encode()) for q in vocab.pieces_of(m)]) for m in matches]

    def count_batch(self, texts: pa.Array) -> np.ndarray:
        """Word pieces of each text."""
        matches, index, starts = vocab.numbered_pieces(texts)
        counts = np.array(vocab.memoised(self.known, matches, self.learn), dtype=np.int64)
        return np.add.reduceat(counts[index], starts[:-1]) if len(starts) > 1 else counts

    def count(self, text: str) -> int:
        return int(self.count_batch(pa.array([text]))[0])


def token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_tokens, n_bytes)`` for every row of ``docs`` (``doc_id``, ``text``): the greedy
    longest-match pieces of each match of the split pattern, over whole texts.

    Null and empty texts count 0. Repeated rows and null ids keep their rows;
    other columns are not read. ``path`` is a rank file with all 256 single bytes.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    shared = vocab.share_file(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        counter = vocab.once_per_worker("counts", shared.value, Counter)
        for batch in batches:
            for part in common.parts(batch):
                texts = part.column("text")
                yield common.out_batch(schema, part.column("doc_id"), counter.count_batch(texts),
                                       pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, n_bytes long")
