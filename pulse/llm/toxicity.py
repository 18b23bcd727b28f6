"""Toxicity of texts whose words may be disguised.

A noisy channel takes written words to plain ones: letters may be written as digits or
signs that look like them, drawn out, or set apart by spaces and dots. A
written word spans a lattice of the letters each of its characters may stand for (and
of runs kept, halved or made single); the Viterbi path under a character trigram model is
its restored form. Neighbouring words span one lattice, in which each separator is either skipped or ends a word;
where both sides are plain it is decided by the two letters on each side alone, as the trigrams across it are
all that differs, so those decisions are remembered. Words that the path joins count besides the written ones. Scoring
numbers the distinct tokens of a batch, restores each once, decides each pair of letters once, and walks through the words
of a text only where tokens are disguised or joined. The model counts trigrams over the words of all documents and, with
weight of its own, over words that mark toxic training documents, since those are what
gets disguised.

Restored words are scored by evidence tables of whole words and of their beginnings, learned
from labelled documents: the longest one that the sample knows well speaks for a word. A
text's score is the calibrated evidence of its strongest words. For the calibration a sampled document is measured by what the
others say, its own part taken out of every count, as an unseen text will be.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common, labelled

FOLDS, HELD_OUT = 3, 1
CUT = 0.7
TRAIN_DOCS = 6000
#: Sample documents that must hold a word or beginning before it is evidence.
MIN_DOCS = 3
#: Shortest and longest beginnings of a word that are evidence of their own.
SHORTEST, LONGEST = 3, 12
#: Documents at the common rate that every gram is taken to have been found in besides.
PRIOR_DOCS = 2.0
#: Entries of a worker's memos of restored words and their evidence; results do not depend on it.
MEMO_ENTRIES = 150_000
_STRONGEST = 5
_STEPS = (0.3, 0.5, 0.65, 0.78, 0.87, 0.93, 0.97)
_FEATURES = len(_STEPS) + len(_STEPS[::2]) + 1

#: What a character that is no letter may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
_LOOK_COST = 1.0  # a sign stands for a letter
_SKIP_COST = 8.0  # a sign within a word stands for nothing
_EDGE_COST = 2.0  # a sign at a word's edge stands for nothing
_HALVE_COST = 0.5  # a long run of letters stands for one or two
_JOIN_COST = 2.0  # a separator within a word
_SINGLE_COST = 4.0  # a double letter stands for one
#: Letters from which on a sign at the edge of a token ends a sentence rather than stands for a letter.
_LONG = 4

_TOKEN = re.compile(r"\S+").findall
#: White space as Python has it, for Arrow.
_BETWEEN = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: Words of letters whose lower case is one letter each, and a letter three times.
_LATIN = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
_EASY, _DRAWN = f"^[{_LATIN}]{{2,}}$", "|".join(c * 3 for c in _LATIN)
#: Characters of tokens that are remembered.
_REMEMBERED = 64
#: Characters around a word that say nothing about it; signs of LOOKS_LIKE stay when single.
_EDGE = "\"'.,;:?*#%&-_~`<>[]{}/\\=^…«»“”„’"
_NOISE = re.compile(r"^(?:([^\w\s])\1+)+|(?:([^\w\s])\2+)+$")
_PLAIN = re.compile(r"[^\W\d_]+").fullmatch
_RUN = re.compile(r"(.)\1\1")
_SPLIT = re.compile(r"[.\-_*/\\'’,·•]+")
_LETTERS = re.compile(r"[^\W\d_]+").findall

_A = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyzàâäáãåçèéêëìíîïñòóôöõùúûüýßœæ")}
_SYMBOLS = len(_A) + 2  # 0: beyond the word; last: any other letter


def _code(word: str) -> list[int]:
    return [_A.get(c, _SYMBOLS - 1) for c in word]


def trigram_table(words: Counter) -> np.ndarray:
    """Counts of letter trigrams, words framed by 0, flat over three symbols."""
    counts = np.zeros(_SYMBOLS**3, dtype=np.float64)
    for word, n in words.items():
        at = [0, 0, *_code(word), 0]
        for a, b, c in zip(at, at[1:], at[2:]):
            counts[(a * _SYMBOLS + b) * _SYMBOLS + c] += n
    return counts


@dataclass
class Model:
    costs: np.ndarray  # negative log probability of the third letter of each trigram
    evidence: dict[str, tuple[int, int]]  # toxic and other documents that hold a gram
    rate: float
    slope: tuple[float, ...]
    restored: dict[str, str] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    spans: dict[str, tuple | None] = field(default_factory=dict)
    short: dict[str, str | None] = field(default_factory=dict)
    known: dict[str, tuple] = field(default_factory=dict)

    def __post_init__(self):
        # A word that begins with none of these has no evidence above the rate.
        self.odds = {g: (p + PRIOR_DOCS * self.rate) / (p + n + PRIOR_DOCS) for g, (p, n) in self.evidence.items() if p + n >= MIN_DOCS}
        #: Known grams by length, whole words under 0, and their evidence, for Arrow.
        by_length: dict[int, list[str]] = {}
        for gram in self.odds:
            by_length.setdefault(0 if gram.endswith("$") else len(gram), []).append(gram)
        self.known_grams = {n: (pa.array([g.removesuffix("$") for g in held], pa.string()), np.array([self.odds[g] for g in held]))
                            for n, held in sorted(by_length.items(), reverse=True)}
        raising = [g for g, (p, n) in self.evidence.items() if (p + PRIOR_DOCS * self.rate) / (p + n + PRIOR_DOCS) > self.rate]
        self.three, self.four = {g for g in raising if len(g) == SHORTEST}, {g[:SHORTEST + 1] for g in raising}

    def __getstate__(self):
        return self.costs, self.evidence, self.rate, self.slope

    def __setstate__(self, state):
        self.costs, self.evidence, self.rate, self.slope = state
        self.restored, self.weights, self.spans, self.short, self.known = {}, {}, {}, {}, {}
        self.__post_init__()

    def viterbi(self, written: str, open_end: bool = False) -> str:
        """Cheapest reading of a written word, or of words and spaces that may be skipped. With ``open_end``
        the last word goes on."""
        runs: list[tuple[str, int]] = []
        for c in written:
            if runs and runs[-1][0] == c:
                runs[-1] = (c, runs[-1][1] + 1)
            else:
                runs.append((c, 1))
        # Last two letters: cost so far and the reading as a chain from its end, so time grows with the runs only.
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for place, (c, n) in enumerate(runs):
            options: list[tuple[str, float]] = []
            if c == " ":
                options += [("", _JOIN_COST), (" ", 0.0)]
            elif c.isalpha():
                options.append((c * min(n, 2), 0.0 if n <= 2 else _HALVE_COST))
                if n > 1:
                    options.append((c, _HALVE_COST if n > 2 else _SINGLE_COST))
            else:
                for letter in LOOKS_LIKE.get(c, ""):
                    options.append((letter, _LOOK_COST))
                    if n > 1:
                        options.append((letter * 2, _LOOK_COST + _HALVE_COST))
                edge = not c.isdigit() and (place in (0, len(runs) - 1) or " " in (runs[place - 1][0], runs[place + 1][0]))
                options.append(("", _EDGE_COST if edge else _SKIP_COST))
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, reading) in paths.items():
                for letters, extra in options:
                    x, y, total = a, b, cost + extra
                    if letters == " ":
                        total, x, y = total + self.costs[(a * _SYMBOLS + b) * _SYMBOLS], 0, 0
                        best = ahead.get((x, y))
                        if best is None or total < best[0]:
                            ahead[x, y] = (total, (reading, letters))
                        continue
                    for code in _code(letters):
                        total += self.costs[(x * _SYMBOLS + y) * _SYMBOLS + code]
                        x, y = y, code
                    best = ahead.get((x, y))
                    if best is None or total < best[0]:
                        ahead[x, y] = (total, (reading, letters) if letters else reading)
            paths = ahead
        chain = min(((cost + (0.0 if open_end else self.costs[(a * _SYMBOLS + b) * _SYMBOLS]), reading)
                     for (a, b), (cost, reading) in paths.items()), key=operator.itemgetter(0))[1]
        letters = []
        while chain:
            chain, last = chain
            letters.append(last)
        return "".join(reversed(letters))

    def restore(self, token: str) -> str:
        """Plain lower-case form of a token without white space; parts it falls into are joined by spaces."""
        known = self.restored.get(token)
        if known is None:
            if len(self.restored) >= MEMO_ENTRIES:
                self.restored.clear()
            known = self.restored[token] = self._restore(token.lower())
        return known

    def _restore(self, token: str) -> str:
        if _PLAIN(token):  # no signs to take off
            return token if not _RUN.search(token) else self.viterbi(token)
        core = _NOISE.sub("", token).strip(_EDGE)
        if core.endswith(("!", ")")) or core.startswith("("):
            core = core.rstrip("!)").lstrip("(")
        if _PLAIN(core) and not _RUN.search(core):
            return core
        parts = _SPLIT.split(core)
        if len(parts) > 2 and all(len(p) <= 1 for p in parts):  # s.e.t apart
            parts = ["".join(parts)]
        words = [w for p in parts if p for w in self._word(p).split(" ") if w]
        return " ".join(words + self._across([p for p in parts if p], words)) if len(words) > 1 else " ".join(words)

    def _across(self, tokens: list[str], plain: list[str]) -> list[str]:
        """Words that the cheapest path joins from neighbouring tokens; ``plain`` are the restored tokens."""
        if len(tokens) != len(plain):
            return []
        out: list[str] = []
        spans, short = self.spans, self.short
        left = ""  # the word so far, whose last two letters the decision depends on
        joined = False
        loose: list[str] = []
        for token, word in zip([*tokens, ""], [*plain, ""]):
            if token and (raw := short[token] if token in short else self._loose(token)):
                loose.append(raw)
                continue
            if " " in word:  # falls into parts: nothing is joined to it
                word = ""
            if loose:
                key = f"{left[-2:]} {' '.join(loose)} {word[:2]}"
                loose = []
            elif left and word:
                key = f"{left[-2:]} {word[:2]}"
            else:
                if joined:
                    out.append(left)
                left, joined = word, False
                continue
            read = spans.get(key, 0)
            if read == 0:
                read = self._known_read(key)
            if read is None:  # nothing is joined
                if joined:
                    out.append(left)
                left, joined = word, False
                continue
            words, starts, ends = read
            first = left[:-2] + words[0] if starts else None
            if first is not None and len(words) == 1 and ends:
                left, joined = first + word[2:], True
                continue
            if first is not None:
                if joined or words[0] != left[-2:]:
                    out.append(first)
            out += words[1 if starts else 0: -1 if ends else None]
            joined = ends and words[-1] != word[:2]
            left = words[-1] + word[2:] if ends else ""
        return out

    def _known_read(self, key: str):
        read = self.spans.get(key, 0)
        if read == 0:
            read = self._read(key)
            if len(key) <= 16:
                if len(self.spans) >= MEMO_ENTRIES:
                    self.spans.clear()
                self.spans[key] = read
        return read

    def _read(self, key: str):
        """The words of the cheapest path and whether the first and last go on; None if no words are joined."""
        starts, ends = not key.startswith(" "), not key.endswith(" ")
        if len(set(key) - {" "}) < 2:
            return None
        read = self.viterbi(key.strip(), open_end=ends)
        if read.count(" ") >= key.strip().count(" "):
            return None
        return [w for w in read.split(" ") if w], starts, ends

    def _loose(self, token: str) -> str | None:
        """A single character, or a token with look-alikes among letters, as it is written: it is read with its neighbours."""
        bare = token if _PLAIN(token) else token.strip(_EDGE + "|") or token
        if len(bare) >= _LONG and bare.endswith(("!", ")")) or bare.startswith("("):
            bare = bare.rstrip("!)").lstrip("(") or bare
        raw = None
        if len(bare) == 1:
            raw = bare.lower() if bare.isalpha() or bare in LOOKS_LIKE else None
        elif not _PLAIN(bare) and any(map(str.isalpha, bare)) and all(c.isalpha() or c in LOOKS_LIKE for c in bare):
            raw = bare.lower()
        if len(self.short) >= MEMO_ENTRIES:
            self.short.clear()
        self.short[token] = raw
        return raw

    def _word(self, word: str) -> str:
        if _PLAIN(word) and not _RUN.search(word):
            return word
        letters = sum(map(str.isalpha, word))
        if not letters or any(not c.isalpha() and c not in LOOKS_LIKE for c in word):
            return " ".join(_LETTERS(word))
        return self.viterbi(word)

    def words(self, text: str) -> list[str]:
        """All restored words of a text. Single characters in a row are read as one spaced-out
        word as well, in which runs are not drawn out letters only."""
        written, joined = self.readings(text)
        return written + joined

    def readings(self, text: str) -> tuple[list[str], list[str]]:
        """Restored words as they are written, and those that neighbouring ones make."""
        tokens = _TOKEN(text)
        get, restore = self.restored.get, self.restore
        plain = [restore(t) if (r := get(t)) is None else r for t in tokens]
        out = self._across(tokens, plain)
        single: list[str] = []
        short = self.short
        for token in tokens + ["end"]:
            if len(token) <= 2 and (raw := short[token] if token in short else self._loose(token)) and len(raw) == 1:
                single.append(raw)
            elif single:
                if len(set(single)) > 1:
                    joined = self._word("".join(single))
                    # The first or last letter may be a word of its own.
                    out += [joined, joined[1:], joined[:-1]]
                single = []
        return " ".join(plain).split(" ") if plain else [], out

    def weight(self, word: str, own: int | None = None) -> float:
        """Evidence of the longest known of the word and its beginnings. ``own``: the label of the
        document the word is in, if that document is part of the counts and is to be left out."""
        evidence = self.evidence
        for gram in grams(word):
            if gram in evidence:
                p, n = evidence[gram]
                if own is not None:
                    p, n = p - own, n - 1 + own
                if p + n >= MIN_DOCS:
                    return (p + PRIOR_DOCS * self.rate) / (p + n + PRIOR_DOCS)
        return self.rate

    def known_weight(self, word: str) -> float:
        known = self.weights.get(word)
        if known is None:
            if len(self.weights) >= MEMO_ENTRIES:
                self.weights.clear()
            known = self.weights[word] = self.joined_weight(word)
        return known

    def joined_weight(self, word: str) -> float:
        """What ``weight`` says of a word that is not remembered, if that is above the rate."""
        if word[:SHORTEST] in self.three or (word + "$")[:SHORTEST + 1] in self.four:
            get = self.odds.get
            known = get(word + "$")
            if known is not None:
                return known
            for n in range(min(LONGEST, len(word)), SHORTEST - 1, -1):
                known = get(word[:n])
                if known is not None:
                    return known
        return self.rate

    def weights_of(self, words: pa.Array) -> np.ndarray:
        """``weight`` of many words: whole ones first, then by the longest beginning."""
        out = np.full(len(words), self.rate)
        todo = np.arange(len(words))
        for n in [0, *[n for n in self.known_grams if n]]:
            if n not in self.known_grams or not len(todo):
                continue
            held, odds = self.known_grams[n]
            rest = words.take(pa.array(todo))
            at = pc.index_in(pc.utf8_slice_codeunits(rest, start=0, stop=n) if n else rest, value_set=held)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            out[todo[hit]] = odds[at.drop_null().to_numpy()]
            todo = todo[~hit]
        return out

    def features(self, text: str, own: int | None = None) -> list[float]:
        """Which steps the strongest and the second strongest distinct word reach, and the mean of
        the five strongest beyond what a text without evidence has."""
        if own is None:
            written, joined = self.readings(text)
            written, get, known, rare = set(written), self.weights.get, self.known_weight, self.joined_weight
            weights = [known(w) if (p := get(w)) is None else p for w in written]
            weights += [rare(w) for w in set(joined) if w not in written]
        else:
            weights = [self.weight(w, own) for w in set(self.words(text))]
        return self._told([p for p in weights if p > self.rate])

    def _told(self, weights: list[float]) -> list[float]:
        """The features of a text whose distinct words have these weights above the rate."""
        rate = self.rate
        found = sorted(weights, reverse=True)[:_STRONGEST]
        found = found + [rate] * (_STRONGEST - len(found))
        return ([float(found[0] > s) for s in _STEPS] + [float(found[1] > s) for s in _STEPS[::2]]
                + [sum(found) / _STRONGEST - self.rate])

    def _probability(self, told: list[float]) -> float:
        at = sum(map(operator.mul, self.slope, (*told, 1.0)))
        return 1 / (1 + math.exp(-min(max(at, -500.0), 500.0)))

    def score(self, text: str) -> float:
        return self._probability(self.features(text))

    def _about(self, token: str) -> tuple:
        """(plain word, empty if it falls into parts; the token as a loose one; as a single letter; words above the rate)."""
        known = self.known.get(token)
        if known is None:
            plain, raw = self.restore(token), self._loose(token)
            single = raw if raw and len(token) <= 2 and len(raw) == 1 else None
            strong = tuple(w for w in set(plain.split(" ")) if self.known_weight(w) > self.rate)
            known = ("" if " " in plain else plain, raw, single, strong)
            if len(token) <= _REMEMBERED:
                if len(self.known) >= MEMO_ENTRIES:
                    self.known.clear()
                self.known[token] = known
        return known

    def _tokens(self, tokens: pa.Array) -> tuple[pa.Array, dict[int, str], dict[int, str], dict[int, tuple]]:
        """What ``_about`` says of distinct tokens: their words, and by place the loose ones, the single letters and the
        words above the rate of those that fall into parts."""
        core = pc.utf8_trim(tokens, characters=_EDGE)
        words = pc.utf8_lower(core)
        # Most tokens: letters, with or without marks around them.
        easy = pc.and_(pc.match_substring_regex(words, _EASY), pc.invert(pc.match_substring_regex(words, _DRAWN)))
        easy = pc.and_(easy, pc.invert(pc.match_substring(core, "\u0130")))
        raws, singles, strong, others = {}, {}, {}, []
        hard = np.flatnonzero(~easy.to_numpy(zero_copy_only=False))
        for k, token in zip(hard.tolist(), tokens.take(pa.array(hard)).to_pylist()):
            word, raw, single, told = self._about(token)
            others.append(word)
            if raw is not None:
                raws[k] = raw
            if single is not None:
                singles[k] = single
            if told and told != (word,):
                strong[k] = told
        return pc.replace_with_mask(words, pc.invert(easy), pa.array(others, pa.string())), raws, singles, strong

    def scores(self, texts: pa.Array) -> list[float]:
        """``score`` of every text of a batch."""
        split = pc.split_pattern_regex(pc.fill_null(texts, ""), pattern=_BETWEEN)
        flat = split.flatten()
        some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[some]
        coded = flat.filter(pa.array(some)).dictionary_encode()
        out = [self._probability(self._told([]))] * len(texts)
        if not len(doc):
            return out
        token = coded.indices.to_numpy()
        words, raws, singles, strong = self._tokens(coded.dictionary)
        extra: dict[int, set[str]] = {}  # words that are not a token's own
        for place in np.flatnonzero(_flags(strong, len(words))[token]).tolist():
            extra.setdefault(int(doc[place]), set()).update(strong[token[place]])
        names = words.to_pylist()
        self._join_all(extra, doc, token, words, names, raws)
        self._join_singles(extra, doc, token, singles, len(words))
        # The strongest distinct words of each text.
        distinct = words.dictionary_encode()
        weight, number = self.weights_of(distinct.dictionary), distinct.indices.to_numpy()
        held = weight[number][token] > self.rate
        n = len(distinct.dictionary)
        of, word = np.divmod(np.unique(doc[held] * n + number[token[held]]), n)
        order = np.lexsort((-weight[word], of))
        of, word = of[order], word[order]
        first = np.searchsorted(of, of)
        best = np.arange(len(of)) - first < _STRONGEST
        told: dict[int, list[tuple[str, float]]] = {}
        for k, name, w in zip(of[best].tolist(), distinct.dictionary.take(pa.array(word[best])).to_pylist(), weight[word[best]].tolist()):
            told.setdefault(k, []).append((name, w))
        for k in {*told, *extra}:
            strongest = dict(told.get(k, ()))
            strongest.update((w, self.joined_weight(w)) for w in extra.get(k, ()))
            out[k] = self._probability(self._told([w for w in strongest.values() if w > self.rate]))
        return out

    def _join_all(self, found: dict[int, set[str]], doc: np.ndarray, token: np.ndarray, plain: pa.Array, words: list[str],
                  raws: dict[int, str]) -> None:
        """Add the words that ``_across`` joins: it is walked from each loose token, and from each pair of
        neighbours that is read otherwise than it is written, until nothing more is joined."""
        loose = _flags(raws, len(words))
        usable = pc.not_equal(plain, "").to_numpy(zero_copy_only=False) & ~loose
        last = pc.utf8_slice_codeunits(plain, start=-2).dictionary_encode()
        first = pc.utf8_slice_codeunits(plain, start=0, stop=2).dictionary_encode()
        lasts, firsts = last.dictionary.to_pylist(), first.dictionary.to_pylist()
        last, first = last.indices.to_numpy(), first.indices.to_numpy()
        at = np.flatnonzero((doc[1:] == doc[:-1]) & usable[token[:-1]] & usable[token[1:]])
        pair = last[token[at]].astype(np.int64) * len(firsts) + first[token[at + 1]]
        event = loose[token]
        self._settle_alone(event, doc, token, raws, last, first, lasts, firsts)
        reads = np.zeros(len(lasts) * len(firsts), dtype=bool)
        reads[pair] = True
        for code in np.flatnonzero(reads).tolist():
            reads[code] = self._known_read(f"{lasts[code // len(firsts)]} {firsts[code % len(firsts)]}") is not None
        event[at[reads[pair]] + 1] = True
        events = np.flatnonzero(event).tolist()
        ends = np.searchsorted(doc, np.arange(int(doc[-1]) + 1), "right").tolist()
        starts = [0, *ends[:-1]]
        here = 0  # nothing before this place is left to be walked
        rate, weight = self.rate, self.joined_weight
        at_doc = doc[events].tolist() if events else []
        for place, k in zip(events, at_doc):
            if place < here:
                continue
            joined: list[str] = []
            here = self._walk(joined, token, words, raws, place, starts[k], ends[k])
            for w in joined:
                if weight(w) > rate:
                    found.setdefault(k, set()).add(w)

    def _settle_alone(self, event: np.ndarray, doc: np.ndarray, token: np.ndarray, raws: dict[int, str], last: np.ndarray,
                      first: np.ndarray, lasts: list[str], firsts: list[str]) -> None:
        """Take out the loose tokens between plain neighbours that join nothing: that depends on the token and the letters
        next to it alone."""
        same = np.concatenate([[False], doc[1:] == doc[:-1], [False]])  # as the token before
        lonely = event & ~(np.concatenate([[False], event[:-1]]) & same[:-1]) & ~(np.concatenate([event[1:], [False]]) & same[1:])
        at = np.flatnonzero(lonely)
        if not len(at):
            return
        raw = pa.array([raws[t] for t in token[at].tolist()], pa.string()).dictionary_encode()
        names = raw.dictionary.to_pylist()
        before = np.where(same[at], last[token[at - 1]], len(lasts))
        after = np.where(same[at + 1], first[token[np.minimum(at + 1, len(token) - 1)]], len(firsts))
        codes = (before.astype(np.int64) * len(names) + raw.indices.to_numpy()) * (len(firsts) + 1) + after
        held, code = np.unique(codes, return_inverse=True)
        lasts, firsts = [*lasts, ""], [*firsts, ""]
        plain = []
        for c in held.tolist():
            c, f = divmod(c, len(firsts))
            b, n = divmod(c, len(names))
            plain.append(self._known_read(f"{lasts[b]} {names[n]} {firsts[f]}") is None)
        event[at[np.array(plain)[code]]] = False

    def _walk(self, out: list[str], token: np.ndarray, words: list[str], raws: dict[int, str], place: int, start: int, end: int) -> int:
        """``_across`` from ``place`` on, until it has joined nothing; the place where it stopped."""
        left = words[token[place - 1]] if place > start else ""
        joined = False
        spans = self.spans
        loose: list[str] = []
        while place <= end:
            word = ""
            if place < end:
                k = int(token[place])
                if k in raws:
                    loose.append(raws[k])
                    place += 1
                    continue
                word = words[k]
            place += 1
            if loose:
                key = f"{left[-2:]} {' '.join(loose)} {word[:2]}"
                loose = []
            elif left and word:
                key = f"{left[-2:]} {word[:2]}"
            else:
                key = None
            read = None if key is None else spans.get(key, 0)
            if read == 0:
                read = self._known_read(key)
            if read is None:
                if joined:
                    out.append(left)
                return min(place, end)
            parts, starts_, ends_ = read
            begun = left[:-2] + parts[0] if starts_ else None
            if begun is not None and len(parts) == 1 and ends_:
                left, joined = begun + word[2:], True
                continue
            if begun is not None and (joined or parts[0] != left[-2:]):
                out.append(begun)
            out += parts[1 if starts_ else 0: -1 if ends_ else None]
            joined = ends_ and parts[-1] != word[:2]
            left = parts[-1] + word[2:] if ends_ else ""
        return end

    def _join_singles(self, found: dict[int, set[str]], doc: np.ndarray, token: np.ndarray, singles: dict[int, str], n: int) -> None:
        """Add the words that rows of single letters make."""
        places = np.flatnonzero(_flags(singles, n)[token])
        if not len(places):
            return
        new = np.concatenate([[True], (np.diff(places) > 1) | (doc[places[1:]] != doc[places[:-1]])])
        starts = np.flatnonzero(new)
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(places)]):
            if z - a < 2:
                continue
            letters = [singles[t] for t in token[places[a:z]].tolist()]
            if len(set(letters)) > 1:
                whole = self._word("".join(letters))
                for w in (whole, whole[1:], whole[:-1]):
                    if self.joined_weight(w) > self.rate:
                        found.setdefault(int(doc[places[a]]), set()).add(w)


def _flags(places, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[list(places)] = True
    return out


def grams(word: str) -> list[str]:
    """The word itself (marked by its end) and its beginnings, longest first."""
    return [word + "$"] + [word[:n] for n in range(min(LONGEST, len(word)), SHORTEST - 1, -1)]


def _costs(corpus: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Negative log probabilities: half the corpus' trigrams, half those of the marked words, each
    smoothed towards the bigrams'."""
    total = np.zeros_like(corpus)
    parts = [t for t in (corpus, marked) if t.sum() > 0]
    for counts in parts or [np.ones_like(corpus)]:
        cube = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
        pair = cube.sum(axis=0)
        pair = (pair + 0.5 / _SYMBOLS) / (pair.sum(axis=1, keepdims=True) + 0.5)
        three = (cube + 2.0 * pair[None]) / (cube.sum(axis=2, keepdims=True) + 2.0)
        total += three.reshape(-1) / max(len(parts), 1)
    return -np.log(total + 1e-12)


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Letter trigram counts over the plain words of all documents. Every task sums its own
    table; what reaches the driver is one row per trigram, whatever the number of documents."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])
    table = np.full(0x250, _SYMBOLS - 1, dtype=np.int16)
    for c, i in _A.items():
        table[ord(c)] = i
        if len(c.upper()) == 1 and ord(c.upper()) < 0x250:
            table[ord(c.upper())] = i
    for point in range(0x250):
        if not chr(point).isalpha():
            table[point] = 0

    def run(batches):
        counts = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for _, found in common.texts(batch):
                points = np.frombuffer((" " + " ".join(found) + "  ").encode("utf-32-le"), dtype="<u4")
                code = table[np.minimum(points, 0x24F)].astype(np.int32)
                # Two frames before each word: a letter after a frame has a frame before that too.
                before = np.roll(code, 2)
                before[np.roll(code, 1) == 0] = 0
                keep = (code > 0) | (np.roll(code, 1) > 0)
                flat = (before * _SYMBOLS + np.roll(code, 1)) * _SYMBOLS + code
                counts += np.bincount(flat[keep], minlength=_SYMBOLS**3)
        some = np.flatnonzero(counts)
        yield common.out_batch(schema, some.astype(np.int32), counts[some])

    rows = (docs.select(F.col("text").cast("string")).mapInArrow(run, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(_SYMBOLS**3)
    for r in rows:
        out[r.gram] = r.n
    return out


def _gram_counts(sample: DataFrame, base: Model) -> DataFrame:
    """``(gram, p, n)``: toxic and other documents that hold a gram."""
    schema = pa.schema([("gram", pa.string()), ("p", pa.int64()), ("n", pa.int64())])
    shared = sample.sparkSession.sparkContext.broadcast(base)

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for part, found in common.texts(batch):
                for y, text in zip(part.column("y").to_pylist(), found):
                    for g in {g for w in set(shared.value.words(text)) if w for g in grams(w)}:
                        counts.setdefault(g, [0, 0])[1 - y] += 1
                if len(counts) > 300_000:
                    yield pack(counts)
                    counts = {}
        yield pack(counts)

    def pack(counts):
        values = list(counts.values())
        return common.out_batch(schema, list(counts), [p for p, _ in values], [n for _, n in values])

    return (sample.select("y", "text").mapInArrow(run, "gram string, p long, n long")
            .groupBy("gram").agg(F.sum("p").alias("p"), F.sum("n").alias("n")))


def _evidence(sample: DataFrame, base: Model, rate: float) -> dict[str, tuple[int, int]]:
    """Counts of the grams that matter: those well above the rate of toxic documents, and those that begin
    with one of them (they say that a beginning is harmless in a longer word). Their number is bounded by the sample.

    A gram in ``p`` toxic of ``p + n`` documents counts as ``(p + PRIOR_DOCS * rate) / (p + n + PRIOR_DOCS)``.
    """
    counts = common.cut(_gram_counts(sample, base).where(F.expr(f"p + n >= {MIN_DOCS}")))
    value = (F.col("p") + PRIOR_DOCS * rate) / (F.col("p") + F.col("n") + PRIOR_DOCS)
    raising = counts.where(value > 2 * rate)
    begin = F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length("gram") - 1, F.lit(LONGEST))),
                        lambda k: F.substring("gram", F.lit(1), k))
    taking_back = (counts.where(value <= 2 * rate).where(F.length("gram") > SHORTEST)
                   .withColumn("begin", F.explode(begin))
                   .join(raising.select(F.col("gram").alias("begin")), "begin", "left_semi")
                   .drop("begin").distinct())
    return {r.gram: (r.p, r.n) for r in raising.collect() + taking_back.collect()}


def _logistic(rows: list[tuple[float, ...]]) -> tuple[float, ...]:
    """Logistic regression of the last entry on the others, by damped Newton steps with a light pull
    towards small rising weights; no weight falls below 0, so more evidence never lowers a score."""
    x = np.array([(*r[:-1], 1.0) for r in rows])
    y = np.array([r[-1] for r in rows], dtype=float)
    pull = np.array([0.3] * (x.shape[1] - 1) + [0.01])
    start = np.array([0.3] * (x.shape[1] - 1) + [-1.0])
    beta = start.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - pull * (beta - start)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -1, 1)
        beta[:-1] = np.maximum(beta[:-1], 0)
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``limit`` labelled documents outside the held-out fold; trigrams over all documents."""
    spark = docs.sparkSession
    common.ship_package(spark)
    corpus = corpus_trigrams(docs)
    sample = common.cut(labelled.training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, limit))
    toxic, n = sample.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    rate = max(toxic / max(n, 1), 1e-3)
    even = (0.0,) * _FEATURES + (math.log((toxic + 1) / (n - toxic + 1)),)
    if toxic in (0, n):
        return Model(_costs(corpus, np.zeros_like(corpus)), {}, rate, even)
    evidence = _evidence(sample, Model(_costs(corpus, np.zeros_like(corpus)), {}, rate, even), rate)
    marked = Counter({g[:-1]: 1.0 for g, (p, q) in evidence.items()
                      if g.endswith("$") and (p + PRIOR_DOCS * rate) / (p + q + PRIOR_DOCS) > 0.7})
    model = Model(_costs(corpus, trigram_table(marked)), evidence, rate, even)
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("f", pa.list_(pa.float64())), ("y", pa.int32())])

    def run(batches):
        for batch in batches:
            for part, found in common.texts(batch):
                marks = part.column("y").to_pylist()
                yield common.out_batch(schema, part.column("doc_id"), [
                    shared.value.features(t, own=y) for t, y in zip(found, marks)], part.column("y"))

    rows = sample.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, f array<double>, y int").collect()
    model.slope = _logistic([(*r.f, r.y) for r in sorted(rows, key=lambda r: r.doc_id)])
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``held_out`` (fold 1 of 3 by crc32 of the
    id), ``score``, ``predicted`` (1 if ``score >= 0.7``).

    Null and empty texts have no words and get the score of a text without evidence. A null id is
    in no fold: ``held_out`` is false. Repeated rows keep their rows. Without labels of both
    classes all texts get the smoothed share of toxic ones. An empty table gives no row.
    """
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # grams of the sample and one trigram table
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for part in common.parts(batch):
                yield common.out_batch(schema, part.column("doc_id"), shared.value.scores(part.column("text")))

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(labelled.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def restore(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, restored)``: the plain words of each text, joined by spaces."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("restored", pa.string())])

    def run(batches):
        for batch in batches:
            for part, found in common.texts(batch):
                yield common.out_batch(schema, part.column("doc_id"),
                                       [" ".join(w for w in shared.value.words(t) if w) for t in found])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, restored string")
