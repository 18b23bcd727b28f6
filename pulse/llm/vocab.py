"""Byte-level vocabularies on the executors, and the split of texts into pieces.

Texts are split before the merges by a fixed pattern, and pieces repeat much more often
than texts do. Arrow splits a batch and numbers its distinct pieces, each distinct piece is
looked up in the worker's bounded memo, and numpy lays the results out in the order
of the texts. Arrow's pattern has no look-ahead, which only matters where two white-space
characters meet; such texts are split by the pattern itself.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

PATTERN = public_tokenizers.PATTERN
#: Vocabulary files are a few MB; a larger one is refused rather than broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
#: Entries a worker's memo of pieces holds; results do not depend on it.
PIECE_ENTRIES = 300_000
#: Longer pieces are not remembered.
PIECE_CHARS = 64

_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Put before each piece by Arrow; a text that holds it, or two white-space characters in a row, is odd.
MARK = "\x01"
_ODD = rf"[{_SPACE}\x{{1c}}-\x{{1f}}]{{2}}|{MARK}"
#: PATTERN for texts that are not odd, as RE2 writes it.
_PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]"
_built: dict[tuple[str, str], object] = {}


class Memo(dict):
    """A bounded memo. When full it takes nothing new, since what repeats most has come early; after
    many times its size in misses the texts have changed, and it starts anew."""

    _TURNS = 10

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.missed = limit, 0

    def add(self, found: dict) -> None:
        """Take in what fits, but for long texts."""
        room = self.limit - len(self)
        if room > 0:
            short = ((k, v) for k, v in found.items() if len(k) <= PIECE_CHARS)
            self.update(itertools.islice(short, room))
            return
        self.missed += len(found)
        if self.missed > self._TURNS * self.limit:
            self.clear()
            self.missed = 0


def share_file(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes for all executors, which need not have the file themselves."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has over {MAX_VOCABULARY_BYTES} bytes: not a vocabulary")
    return spark.sparkContext.broadcast(data)


def once_per_worker(kind: str, data: bytes, build: Callable[[bytes], object]):
    """What ``build`` makes of ``data``, kept for the worker's later tasks."""
    key = (kind, hashlib.blake2b(data, digest_size=16).hexdigest())
    if key not in _built:
        _built[key] = build(data)
    return _built[key]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@functools.cache
def splitter(pattern: str = PATTERN) -> Callable[[str], list[str]]:
    """All matches of the split pattern, with white space as Unicode has it (which is what the
    tokenizer libraries split by)."""
    spaces = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}")
    return regex.compile(spaces).findall


def numbered_pieces(texts: pa.Array, apart: tuple[str, ...] = ()) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, number of each piece in order, start of each text's pieces and their end).

    Every text begins with the empty piece, so it has one at least. An odd text is that and one
    piece of its own, marked; ``pieces_of`` splits it. Texts that hold one of ``apart`` are odd too.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _ODD)
    for held in apart:
        odd = pc.or_(odd, pc.match_substring(texts, held))
    marked = pc.replace_substring_regex(pc.if_else(odd, "", texts), _PIECE, MARK + r"\0")
    split = pc.split_pattern(marked, MARK)
    starts = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    pieces, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    places = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if len(places):
        index = np.insert(index, starts[places + 1], len(pieces) + np.arange(len(places)))
        pieces += [MARK + t for t in texts.take(pa.array(places)).to_pylist()]
        starts = starts + np.concatenate([[0], np.cumsum(odd.to_numpy(zero_copy_only=False))])
    return pieces, index, starts


def pieces_of(piece: str) -> list[str]:
    """The pieces that a numbered piece stands for: itself, none if empty, those of an odd text."""
    if piece[:1] == MARK and len(piece) > 1:
        return splitter()(piece[1:])
    return [piece] if piece else []


def memoised(memo: Memo, pieces: list[str], learn: Callable[[list[str]], list]) -> list:
    """What ``learn`` gives for each piece, as far as ``memo`` does not have it."""
    values = list(map(memo.get, pieces))
    new = [k for k, v in enumerate(values) if v is None]
    if new:
        names = [pieces[k] for k in new]
        learned = learn(names)
        memo.add(dict(zip(names, learned)))
        for k, v in zip(new, learned):
            values[k] = v
    return values


def laid_out(values: list[bytes], index: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings of items of ``width`` bytes, picked by ``index`` and put end to end: (items, start
    of each text's items and their end)."""
    items = np.frombuffer(b"".join(values), dtype=f"u{width}" if width > 1 else "u1")
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // width
    return gathered(items, sizes, index, starts)


def gathered(items: np.ndarray, sizes: np.ndarray, index: np.ndarray, starts: np.ndarray):
    """``items`` of the runs that ``sizes`` cuts them into, picked by ``index`` and put end to end."""
    first = np.cumsum(sizes) - sizes
    picked = sizes[index]
    ends = np.concatenate([[0], np.cumsum(picked)])
    small = np.int32 if max(int(ends[-1]), len(items)) < 2**31 else np.int64
    place = np.repeat((first[index] - ends[:-1]).astype(small), picked)
    place += np.arange(ends[-1], dtype=small)
    return items[place], ends[starts]
