"""Alignment of two tokenizers on every text, with corpus-wide counts of the id pairs that stand over each other.

Both tokenizers encode the whole text (A with a space before it, which B adds itself). The bytes of the tokens of
each must join to space + text; a text for which they do not has no tokens here. Anchors are shared ends before space-marked
tokens: byte offsets, verified in both token sequences, at which the next token of A and that of B begin with a space. They cut a text into
windows of token ids. Groups, the finest pieces in which both sides end together, depend on a window's ids alone,
so alignments of windows are memoised by their id tuples; in a batch each different window is looked up once.

No token of either vocabulary holds a space after a sign at which a text is cut, and both tokenizers work inside the runs between
such spaces, so a text's ids are those of its chunks: runs cut at single spaces between two other signs. Each different chunk is
encoded once per worker while it is remembered. Vocabularies of another kind encode whole texts.

Links pair every token of A with every token of B of the same group. A group keeps its different ids and how often each occurs,
never its pairs of occurrences: ids (a, b) are linked ``times(a) * times(b)`` times. The count of an id pair is the number of documents
that hold it linked. Pairs are counted inside each task first. Those that hold more than one of ``HOT_PAIRS`` (document, pair) rows
are fewer than HOT_PAIRS by definition and broadcast; rows of the others are joined.

Cases: NULL and empty texts, and texts that do not join, have zeros and an empty digest. Special tokens inside a text are
plain text. Equal texts and repeated rows are documents of their own and count each. Ties for the highest count of an A id all
are best. An empty table gives no rows. Columns are carried inside one struct, so no name can clash. A text is handled in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewater.llm import kernel
from tidewater.llm.common import cut

HOT_PAIRS = 1 << 17
MEMO_WINDOWS = 20_000  # windows a worker remembers before it starts anew
OFTEN = 4  # so often in a batch is a window met that is remembered
SLICE = 1 << 19  # bytes of text handled at once
MEMO_CHUNKS = 200_000
MEMO_BYTES = 16_000_000
SMALL_GROUP = 4096  # links of a group that are spelled out before equal ones are added up
COUNTED_PAIRS = 2_000_000  # pairs a counting task holds before it gives them on
SPACE_MARK = "▁"
PAIR_BITS = 32


@dataclass
class Vocabulary:
    """Bytes of every token id."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    spaced: np.ndarray  # begins with a space

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        sizes = np.array([len(t) for t in tokens], np.int64)
        spaced = np.array([t[:1] == b" " for t in tokens])
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes, spaced)

    def tokens(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        return (raw[a : a + n] for a, n in zip(self.starts.tolist(), self.sizes.tolist(), strict=True))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@cache
def byte_level(path: str) -> tuple[Tokenizer, Vocabulary]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return tokenizer, Vocabulary.of([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names])


@cache
def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, Vocabulary]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return model, Vocabulary.of([bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(SPACE_MARK, " ").encode() for i, t in enumerate(names)])


@dataclass
class Runs:
    """Alignments of windows, as arrays: those of window i are at ``x_at[i]`` to ``x_at[i + 1]``."""

    groups: np.ndarray
    links: np.ndarray
    text: np.ndarray  # bytes of the groups, each as a1,a2|b1;
    text_at: np.ndarray
    pairs: np.ndarray  # different id pairs, a in the upper bits
    times: np.ndarray  # their links
    pairs_at: np.ndarray

    def one(self, i: int) -> Runs:
        """A copy of window i."""
        x, y = self.text_at[i : i + 2]
        p, q = self.pairs_at[i : i + 2]
        return Runs(self.groups[i : i + 1].copy(), self.links[i : i + 1].copy(), self.text[x:y].copy(), np.array([0, y - x]), self.pairs[p:q].copy(), self.times[p:q].copy(), np.array([0, q - p]))

    @staticmethod
    def joined(runs: list[Runs]) -> Runs:
        sizes = [np.concatenate([getattr(r, c)[1:] - getattr(r, c)[:-1] for r in runs]) for c in ("text_at", "pairs_at")]
        ends = [np.concatenate(([0], np.cumsum(x))) for x in sizes]
        groups, links, text, pairs, times = (np.concatenate([getattr(r, c) for r in runs]) for c in ("groups", "links", "text", "pairs", "times"))
        return Runs(groups, links, text, ends[0], pairs, times, ends[1])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


@cache
def decimals(n: int) -> Vocabulary:
    """The numbers below n in decimal, each with one more byte."""
    return Vocabulary.of([b"%d," % i for i in range(n)])


def align(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, va: Vocabulary, vb: Vocabulary) -> Runs:
    """Cut windows where both sides end: window i has the next ``n_a[i]`` ids of ``a`` and ``n_b[i]`` of ``b``, over the same bytes."""
    windows = len(n_a)
    size_a, size_b = va.sizes[a], vb.sizes[b]
    at_a, at_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    begins = np.intersect1d(at_a, at_b, assume_unique=True)
    of_a, of_b = np.searchsorted(begins, at_a, "right") - 1, np.searchsorted(begins, at_b, "right") - 1
    in_a, in_b = np.bincount(of_a, minlength=len(begins)), np.bincount(of_b, minlength=len(begins))
    last_a, last_b = np.cumsum(in_a), np.cumsum(in_b)
    first = np.searchsorted(last_a, np.concatenate(([0], np.cumsum(n_a))), "right")  # first group of each window
    first[0] = 0
    links = np.diff(np.concatenate(([0], np.cumsum(in_a * in_b)))[first])
    # The groups as text: ids of A, ids of B.
    ids = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + (last_b - in_b)[of_a]
    place_b = np.arange(len(b)) + last_a[of_b]
    ids[place_a], ids[place_b] = a, b
    d = decimals(max(len(va.sizes), len(vb.sizes)))
    text, ends = d.joined(ids), np.cumsum(d.sizes[ids])
    text = text.copy()
    text[ends[place_a[last_a - 1]] - 1] = 124  # |
    text[ends[place_b[last_b - 1]] - 1] = 59  # ;
    text_at = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    # Id pairs: small groups all at once, large ones by their different ids.
    window = np.repeat(np.arange(windows), np.diff(first))
    size = in_a * in_b
    small = np.flatnonzero(size <= SMALL_GROUP)
    each = size[small]
    inside = spread(np.zeros(len(small), np.int64), each)
    g = np.repeat(small, each)
    x = a[(last_a - in_a)[g] + inside // in_b[g]].astype(np.int64)
    y = b[(last_b - in_b)[g] + inside % in_b[g]]
    owner, pair, times = [window[g]], [x << PAIR_BITS | y], [np.ones(len(g), np.int64)]
    for k in np.flatnonzero(size > SMALL_GROUP).tolist():
        p, m = np.unique(a[last_a[k] - in_a[k] : last_a[k]], return_counts=True)
        q, n = np.unique(b[last_b[k] - in_b[k] : last_b[k]], return_counts=True)
        pair.append(((p.astype(np.int64) << PAIR_BITS)[:, None] | q).ravel())
        times.append((m[:, None] * n).ravel())
        owner.append(np.full(len(p) * len(q), window[k]))
    first_pair, pair, times = summed(windows, np.concatenate(owner), np.concatenate(pair), np.concatenate(times))
    return Runs(np.diff(first), links, text, text_at, pair, times, first_pair)


def summed(n: int, owner: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of each of n owners, with the sums of ``times``; the first entry of each owner leads."""
    ids, number = np.unique(pair, return_inverse=True)
    key = owner * len(ids) + number
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(times[order], begins) if len(key) else times
    key = key[begins]
    return np.searchsorted(key, np.arange(n + 1) * len(ids)), ids[key % max(len(ids), 1)], sums


class Memo:
    """Alignments of windows by their id tuples, bounded in number and size."""

    def __init__(self) -> None:
        self.known: dict[bytes, Runs] = {}
        self.size = 0

    def put(self, key: bytes, window: Runs) -> None:
        self.size += len(key) + len(window.text) + 16 * len(window.pairs)
        if len(self.known) >= MEMO_WINDOWS or self.size > MEMO_BYTES:
            self.known.clear()
            self.size = len(key) + len(window.text) + 16 * len(window.pairs)
        self.known[key] = window


def run_hashes(mixed: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of symbols, each given as a random number."""
    prefix = np.zeros(len(mixed) + 1, np.uint64)
    np.cumsum(mixed * kernel.powers(kernel.BASE, len(mixed)), out=prefix[1:])
    return kernel.mix((prefix[ends] - prefix[starts]) * kernel.powers(kernel.BASE_INV, len(mixed) + 1)[starts])


def different(key: np.ndarray, *runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different run, and of each run which one it is. Runs of one ``key`` are compared; if two differ, all count as different."""
    _, which, each = np.unique(key, return_index=True, return_inverse=True)
    if all(same_runs(symbols, starts, ends, which[each]) for symbols, starts, ends in runs):
        return which, each
    return np.arange(len(key)), np.arange(len(key))


def same_runs(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Whether every run has the ids of the run that ``like`` names for it."""
    sizes = ends - starts
    if (sizes != sizes[like]).any():
        return False
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return bool((ids[np.repeat(starts, sizes) + inside] == ids[np.repeat(starts[like], sizes) + inside]).all())


@dataclass
class Aligned:
    """Alignments of several texts."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    first: np.ndarray  # the id pairs of text i are at first[i] to first[i + 1]
    pairs: np.ndarray
    times: np.ndarray
    groups: list[list[dict]] | None  # ids of A and B by group


def _signs(kept: list[int], but: list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[kept] = True
    out[but] = False
    return out


#: Bytes that may stand before and after a space at which a text is cut. A byte that can begin other white space, or end
#: the sign that B writes for a space, is left out.
BEFORE = _signs([*range(33, 256)], [0x81, 0x85, 0xA0])
AFTER = _signs([*range(33, 127), *range(128, 256)], [0xC2, 0xE1, 0xE2, 0xE3])


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of several texts, and the first chunk of each text and past the last."""
    at = np.flatnonzero(data[1:-1] == 32) + 1
    at = at[BEFORE[data[at - 1]] & AFTER[data[at + 1]]]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at = at[~edge[at] & ~edge[at + 1]]  # both neighbours belong to the same text
    full = np.diff(offsets) > 0
    starts = np.sort(np.concatenate([offsets[:-1][full], at + 1]))
    ends = np.sort(np.concatenate([offsets[1:][full], at]))
    return starts, ends, np.searchsorted(starts, offsets)


class Arena:
    """Ids of many chunks in one array, which grows."""

    def __init__(self) -> None:
        self.flat = np.empty(1 << 12, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 10, np.int64)
        self.sizes = np.zeros(1 << 10, np.int64)

    def put(self, k: int, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of the chunks from number k on."""
        while k + len(sizes) > len(self.sizes):
            self.starts, self.sizes = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.sizes[k : k + len(sizes)] = sizes
        self.starts[k : k + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.va = byte_level(path_a)
        self.b, self.vb = pieces(path_b)
        self.memo = Memo()
        self._forget()
        crossing = re.compile(b"[" + b"".join(re.escape(bytes([x])) for x in np.flatnonzero(BEFORE).tolist()) + b"] ")
        self.by_chunk = not any(crossing.search(t) for v in (self.va, self.vb) for t in v.tokens())

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}  # of each chunk that is remembered
        self.ids = Arena(), Arena()  # of A and of B

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids and first places of texts in UTF-8, of A and of B."""
        if self.by_chunk:
            starts, ends, first = chunks(data, offsets)
        else:
            starts, ends, first = offsets[:-1], offsets[1:], np.arange(len(offsets))
        which, each = different(run_hashes(kernel.BYTE_MIX[data], starts, ends), (data, starts, ends))
        if len(self.number) > MEMO_CHUNKS or self.ids[0].used + self.ids[1].used > MEMO_BYTES:
            self._forget()
        raw = data.tobytes()
        parts = [raw[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]
        self._learn(list(dict.fromkeys(p for p in parts if p not in self.number)))
        chunk = np.array([self.number[p] for p in parts], np.int64)[each]
        out = []
        for arena in self.ids:
            sizes = arena.sizes[chunk]
            total = np.concatenate(([0], np.cumsum(sizes)))
            out += [arena.flat[spread(arena.starts[chunk], sizes)], total[first]]
        return out

    def _learn(self, new: list[bytes]) -> None:
        """Encode chunks: many in one text of A, where they may stand one after the other, by themselves otherwise."""
        apart = np.array([not (p and BEFORE[p[-1]] and AFTER[p[0]]) for p in new], bool)
        for together in (True, False):
            some = [p for p, x in zip(new, apart.tolist(), strict=True) if x != together]
            for lo in range(0, len(some), 512):
                part = some[lo : lo + 512]
                texts = [p.decode() for p in part]
                found = self._together(part) if together and self.by_chunk else None
                if found is None:
                    lists = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
                    found = np.fromiter(chain.from_iterable(lists), np.int32), np.array([len(x) for x in lists], np.int64)
                lists = self.b.encode(texts, num_threads=1)
                k = len(self.number)
                self.ids[0].put(k, *found)
                self.ids[1].put(k, np.fromiter(chain.from_iterable(lists), np.int32), np.array([len(x) for x in lists], np.int64))
                self.number.update(zip(part, range(k, k + len(part)), strict=True))

    def _together(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A of chunks in one text; None if tokens do not end where the chunks do."""
        (found,) = self.a.encode_batch_fast([(b" " + b" ".join(part)).decode()], add_special_tokens=False)
        ids = np.array(found.ids, np.int32)
        want = np.cumsum([len(p) + 1 for p in part])
        ends = np.cumsum(self.va.sizes[ids])
        at = np.searchsorted(ends, want)
        if len(ends) != at[-1] + 1 or (ends[at] != want).any():
            return None
        return ids, np.diff(at + 1, prepend=0)

    def _joins(self, v: Vocabulary, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each text whether its tokens join to a space and the text."""
        n = len(offsets) - 1
        sizes = np.concatenate(([0], np.cumsum(v.sizes[ids])))[first]
        want = np.diff(offsets) + 1
        good = np.diff(sizes) == want
        joined, with_space = v.joined(ids), np.insert(data, offsets[:-1], 32)
        if good.all():
            wrong = np.flatnonzero(joined != with_space)
            good[np.searchsorted(sizes, wrong, "right") - 1] = False
            return good
        starts = offsets[:-1] + np.arange(n)
        for i in np.flatnonzero(good).tolist():
            good[i] = np.array_equal(joined[sizes[i] : sizes[i + 1]], with_space[starts[i] : starts[i] + want[i]])
        return good

    def texts(self, data: np.ndarray, offsets: np.ndarray, groups: bool = False) -> Aligned:
        """Align texts in UTF-8; an empty text stands for NULL too."""
        n = len(offsets) - 1
        a, first_a, b, first_b = self.encode(data, offsets)
        good = (np.diff(offsets) > 0) & self._joins(self.va, a, first_a, data, offsets) & self._joins(self.vb, b, first_b, data, offsets)
        n_a, n_b = np.where(good, np.diff(first_a), 0), np.where(good, np.diff(first_b), 0)
        if not good.all():
            a, b = a[np.repeat(good, np.diff(first_a))], b[np.repeat(good, np.diff(first_b))]
        first_a, first_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
        size_a, size_b = self.va.sizes[a], self.vb.sizes[b]
        at_a, at_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        mark_a, mark_b = self.va.spaced[a], self.vb.spaced[b]
        mark_a[first_a[:-1][n_a > 0]] = mark_b[first_b[:-1][n_b > 0]] = True  # a text begins a window
        anchors = np.intersect1d(at_a[mark_a], at_b[mark_b], assume_unique=True)
        from_a, from_b = np.searchsorted(at_a, anchors), np.searchsorted(at_b, anchors)
        to_a, to_b = np.append(from_a[1:], len(a)), np.append(from_b[1:], len(b))
        if not len(anchors):
            to_a, to_b = from_a, from_b
        window_of, found = self._windows(a, from_a, to_a, b, from_b, to_b)
        first = np.searchsorted(np.searchsorted(first_a, from_a, "right") - 1, np.arange(n + 1))  # first window of each text

        def total(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(values[window_of])))[first])

        sizes = np.diff(found.text_at)[window_of]
        text = found.text[spread(found.text_at[:-1][window_of], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[first].tolist()
        written = [text[p : q - 1] if q > p else None for p, q in zip(ends, ends[1:], strict=False)]
        digests = ["" if t is None else hashlib.sha256(t).hexdigest() for t in written]
        used, repeats = np.unique(np.repeat(np.arange(n), np.diff(first)) * max(len(found.groups), 1) + window_of, return_counts=True)
        owner, window = used // max(len(found.groups), 1), used % max(len(found.groups), 1)
        each = np.diff(found.pairs_at)[window]
        at = spread(found.pairs_at[:-1][window], each)
        pairs = summed(n, np.repeat(owner, each), found.pairs[at], found.times[at] * np.repeat(repeats, each))
        shown = [_parsed(t) for t in written] if groups else None
        return Aligned(n_a, n_b, total(found.groups), total(found.links), digests, *pairs, shown)

    def _windows(self, a, from_a, to_a, b, from_b, to_b) -> tuple[np.ndarray, Runs]:
        """Of each window which it is among the different ones, and their alignments."""
        hash_a, hash_b = (run_hashes(kernel.mix(x.astype(np.uint64)), p, q) for x, p, q in ((a, from_a, to_a), (b, from_b, to_b)))
        which, window_of = different(kernel.mix(hash_a + kernel.mix(hash_b)), (a, from_a, to_a), (b, from_b, to_b))
        # Windows that are rare in a batch are seldom met again: the others are remembered.
        often = np.flatnonzero(np.bincount(window_of, minlength=len(which)) >= OFTEN)
        ends = zip(*(x[which[often]].tolist() for x in (from_a, to_a, from_b, to_b)), strict=True)
        keys = [(q - p).to_bytes(4, "little") + a[p:q].tobytes() + b[r:s].tobytes() for p, q, r, s in ends]
        known = [self.memo.known.get(k) for k in keys]
        is_new = np.ones(len(which), bool)
        is_new[often[[w is not None for w in known]]] = False
        new = which[is_new]
        n_a, n_b = to_a[new] - from_a[new], to_b[new] - from_b[new]
        made = align(a[spread(from_a[new], n_a)], n_a, b[spread(from_b[new], n_b)], n_b, self.va, self.vb)
        at = np.cumsum(is_new) - 1
        for k, i, w in zip(keys, often.tolist(), known, strict=True):
            if w is None:
                self.memo.put(k, made.one(int(at[i])))
        at[~is_new] = len(new) + np.arange(len(which) - len(new))
        return at[window_of], Runs.joined([made, *(w for w in known if w is not None)])


def _parsed(text: np.ndarray | None) -> list[dict]:
    if text is None:
        return []
    sides = (g.split("|") for g in text.tobytes().decode().split(";"))
    return [{"a": [int(i) for i in x.split(",")], "b": [int(i) for i in y.split(",")]} for x, y in sides]


# -- over a table --------------------------------------------------------------------------------------

GROUPS = T.ArrayType(T.StructType([T.StructField(x, T.ArrayType(T.IntegerType())) for x in "ab"]))
ARROW_GROUPS = pa.list_(pa.struct([(x, pa.list_(pa.int32())) for x in "ab"]))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def alignments(rows: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """``rows`` has one struct column ``row`` with a ``text``. Adds n_a, n_b, n_groups, n_links, groups_sha256, the different
    id pairs (``pairs``, a in the upper 32 bits) with their links (``times``), and with ``groups`` the groups themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            text = batch.column(0).field("text")
            if batch.column(0).null_count:
                text = pc.if_else(batch.column(0).is_valid(), text, None)
            for lo, hi, data, offsets in kernel.text_slices(text, SLICE):
                x = aligner.texts(data, offsets, groups)
                first = pa.array(x.first.astype(np.int32))
                out = [batch.column(0).slice(lo, hi - lo), *(pa.array(getattr(x, c)) for c in COLUMNS), pa.array(x.digests, pa.string())]
                out += [pa.ListArray.from_arrays(first, pa.array(v)) for v in (x.pairs, x.times)]
                if groups:
                    out.append(pa.array(x.groups, ARROW_GROUPS))
                yield pa.RecordBatch.from_arrays(out, names)

    fields = [*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in COLUMNS), T.StructField("groups_sha256", T.StringType())]
    fields += [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "times")]
    fields += [T.StructField("groups", GROUPS)] if groups else []
    names = [f.name for f in fields]
    return rows.mapInArrow(run, T.StructType(fields))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): the number of documents that hold an id pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            ids, at = np.unique(np.concatenate([ids, more]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
            if len(ids) > COUNTED_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["pair", "n"])
                ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame) -> DataFrame:
    """Adds ``best``: the count is the highest of its A id. There is one highest count per id of the vocabulary."""
    a = F.shiftright("pair", PAIR_BITS)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def scored(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Adds ``n_best`` (links whose pair has the highest count of its A id) and ``count_sum`` (counts over all links)."""
    aligned = cut(aligned.withColumn("_at", F.monotonically_increasing_id()), "aligned")
    counts = cut(with_best(cut(pair_counts(aligned), "pair-counts")), "best-pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * hot_pairs > F.lit(total)
    found = counts.filter(is_hot).orderBy("pair").toPandas()  # fewer than hot_pairs rows
    hot = aligned.sparkSession.sparkContext.broadcast(tuple(found[c].to_numpy() for c in ("pair", "n", "best")))

    def places(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each pair among the hot ones, and whether it is there."""
        ids = hot.value[0]
        if not len(ids):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(ids, pairs), len(ids) - 1)
        return at, ids[at] == pairs

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            pairs = batch.column(1).flatten().to_numpy()
            cold = ~places(pairs)[1]
            at = np.repeat(batch.column(0).to_numpy(), sizes)
            columns = [pa.array(x[cold]) for x in (at, pairs, batch.column(2).flatten().to_numpy())]
            yield pa.RecordBatch.from_arrays(columns, ["_at", "pair", "times"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.concatenate(([0], np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))))
            at, is_there = places(batch.column(1).flatten().to_numpy())
            times = np.where(is_there, batch.column(2).flatten().to_numpy(), 0)
            n, best = (hot.value[k][at] if len(hot.value[0]) else np.zeros(len(at), np.int64) for k in (1, 2))
            sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[first]) for x in (times * best.astype(np.int64), times * n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums)], ["_at", "best", "sum"])

    lists = aligned.select("_at", "pairs", "times")
    cold = lists.mapInArrow(rare, "_at long, pair long, times long").join(counts.filter(~is_hot), "pair")
    cold = cold.select("_at", F.when(F.col("best"), F.col("times")).otherwise(0).alias("best"), (F.col("times") * F.col("n")).alias("sum"))
    sums = lists.mapInArrow(common, "_at long, best long, sum long").unionByName(cold)
    sums = sums.groupBy("_at").agg(F.sum("best").alias("n_best"), F.sum("sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "_at").drop("_at")
