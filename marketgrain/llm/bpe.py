"""Byte-level BPE over flat arrays: splitting, the library's ids, merging by rank.

``Splitter`` finds the pre-tokens of the byte-level pattern for a whole slice at
once. ``Encoder`` asks the tokenizers library for the ids of every pre-token it
has not met yet in this worker; ``RankMerger`` counts symbols without it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex

from marketgrain.llm import textarrays as ta

OTHER, LETTER, DIGIT, WHITE = 0, 1, 2, 3
REMEMBERED = 2_000_000  # about 400 MB a worker
FEW = 300_000  # about 60 MB, for a stage among others
LONG = 512  # bytes of a pre-token from which pairs are kept by rank
_state: dict = {}


def classes() -> np.ndarray:
    """The class of every code point."""
    if "classes" not in _state:
        every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
        out = np.zeros(0x110000, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
            for match in regex.finditer(pattern, every):
                low, high = ord(every[match.start()]), ord(every[match.end() - 1])
                out[low : high + 1] = kind
        out[0xD800:0xE000] = OTHER
        _state["classes"] = out
        _state["values"] = ta.mix(np.arange(0x110000, dtype=np.uint64) + ta.U(77))
    return _state["classes"]


def pieces(code: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of texts given as code points.

    The pattern: a contraction ('s 't 're 've 'm 'll 'd); or letters, digits or
    other signs, each with a plain space before them; or white space, of which
    the last sign stays with what follows.
    """
    n = len(code)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes()[code]
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets] = True  # also marks the end
    start = opens[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    tail = (kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~opens[1:n]
    at = np.flatnonzero(tail)
    start[at] = True
    start[at[code[at] == 0x20] + 1] = False
    quote = np.flatnonzero((code == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~opens[quote + 1]]
    if len(quote):
        one = code[quote + 1]
        two = np.where(quote + 2 < n, code[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(opens[np.minimum(quote + 2, n)], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & ((np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for marked, length in ((short, 2), (long, 3)):
            found = quote[marked]
            start[found + 1] = False
            after = found + length
            start[after[after < n]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], n)


def codes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, as code points, and their offsets in it."""
    text = data.tobytes().decode("utf-8")
    heads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return text, np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), heads[offsets]


class Rules:
    """The vocabulary file: merges, ids of bytes, special strings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocab = model["model"]["vocab"]
        signs = byte_signs()
        self.signs = {byte: sign for byte, sign in enumerate(signs)}
        self.byte_id = np.array([vocab[s] for s in signs], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        self.size = max(vocab.values()) + 2
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.pair, self.merged = keys, made  # by rank
        self.library = Tokenizer.from_file(path)


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def rules(path: str) -> Rules:
    if ("rules", path) not in _state:
        _state["rules", path] = Rules(path)
    return _state["rules", path]


class Remembered:
    """Pre-tokens met in this worker: hash -> a run in a flat array.

    Words repeat across slices and tasks, so each is worked out about once per
    worker. Older ones are held in sorted hash arrays, the latest in a dict. The
    memory is bounded: past ``limit`` entries it starts anew.
    """

    def __init__(self, work, limit: int = REMEMBERED):
        self.work, self.limit = work, limit  # work: list of texts -> (flat values, lengths)
        self.clear()

    def clear(self) -> None:
        self.sorted = np.zeros(0, dtype=np.uint64)
        self.sorted_place = np.zeros(0, dtype=np.int64)
        self.latest: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int32)
        self.used = self.count = 0

    def settle(self) -> None:
        """Move the latest entries to the sorted arrays."""
        n = len(self.latest)
        keys = np.concatenate([self.sorted, np.fromiter(self.latest.keys(), np.uint64, n)])
        order = np.argsort(keys, kind="stable")
        self.sorted = keys[order]
        self.sorted_place = np.concatenate([self.sorted_place, np.fromiter(self.latest.values(), np.int64, n)])[order]
        self.latest = {}

    def runs(self, hashes: np.ndarray, text_of) -> np.ndarray:
        """Places of the given distinct hashes; ``text_of`` gives texts for indices."""
        if self.count > self.limit:
            self.clear()
        if len(self.latest) > max(100_000, self.count >> 3):
            self.settle()
        out = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            out = np.where(self.sorted[at] == hashes, self.sorted_place[at], -1)
        rest = np.flatnonzero(out < 0)
        keys, get = hashes[rest].tolist(), self.latest.get
        found = np.array([get(k, -1) for k in keys], dtype=np.int64)
        out[rest] = found
        unseen = np.flatnonzero(found < 0)
        if len(unseen):
            values, lengths = self.work(text_of(rest[unseen]))
            base, n = self.count, len(unseen)
            while self.used + len(values) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while base + n > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
                self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.flat[self.used : self.used + len(values)] = values
            ends = np.cumsum(lengths)
            self.start[base : base + n] = self.used + ends - lengths
            self.length[base : base + n] = lengths
            self.used += len(values)
            self.count += n
            out[rest[unseen]] = np.arange(base, base + n)
            self.latest.update((keys[i], base + j) for j, i in enumerate(unseen.tolist()))
        return out


def split_texts(column, special: dict[str, int]):
    """(bytes, offsets, row, id after) with texts cut at special strings.

    ``row`` is the text that a part belongs to and ``id after`` the special id
    that follows the part, or -1."""
    data, offsets = ta.flat(column)
    raw = data.tobytes() if special else b""
    if not any(s.encode() in raw for s in special):
        return data, offsets, np.arange(len(offsets) - 1), np.full(len(offsets) - 1, -1, np.int64)
    cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
    parts, row, after = [], [], []
    for i in range(len(offsets) - 1):
        found = cut.split(raw[offsets[i] : offsets[i + 1]].decode("utf-8"))
        for j in range(0, len(found), 2):
            parts.append(found[j].encode())
            row.append(i)
            after.append(special[found[j + 1]] if j + 1 < len(found) else -1)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return np.frombuffer(b"".join(parts), np.uint8), offsets, np.array(row), np.array(after, dtype=np.int64)


def placed(column, special: dict[str, int], remembered: Remembered):
    """(places of all pre-tokens in order, their part, parts' rows, ids after)."""
    data, offsets, row, after = split_texts(column, special)
    text, code, offsets = codes_of(data, offsets)
    starts, ends = pieces(code, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), row, after
    hashes = ta.spans(code, starts, ends, _state["values"])
    codes, distinct = pd.factorize(hashes)
    at = ta.firsts(codes, len(distinct))
    low, high = starts[at].tolist(), ends[at].tolist()
    place = remembered.runs(distinct, lambda new: [text[low[i] : high[i]] for i in new.tolist()])
    part = np.searchsorted(offsets, starts, "right") - 1
    return place[codes], part, row, after


class Encoder:
    """Ids as the tokenizers library gives them without added special tokens."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.rules = rules(path)
        self.model = self.rules.library.model
        self.remembered = Remembered(self.work, remembered)

    def work(self, texts: list[str]):
        signs, tokenize = self.rules.signs, self.model.tokenize
        ids = [[t.id for t in tokenize(x.encode().decode("latin-1").translate(signs))] for x in texts]
        return np.array([i for run in ids for i in run], dtype=np.uint32), np.array([len(run) for run in ids], dtype=np.int64)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them)."""
        place, part, row, after = placed(column, self.rules.special, self.remembered)
        known, n = self.remembered, len(column)
        lengths = known.length[place]
        ids = known.flat[ta.gather(known.start[place], lengths)]
        per_part = np.bincount(part, weights=lengths, minlength=len(row)).astype(np.int64) if len(part) else np.zeros(len(row), np.int64)
        if (after >= 0).any():
            ends = np.cumsum(per_part)
            ids = np.insert(ids, ends[after >= 0], after[after >= 0].astype(np.uint32))
            per_part = per_part + (after >= 0)
        per_row = np.bincount(row, weights=per_part, minlength=n).astype(np.int64) if len(row) else np.zeros(n, np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_row)])


class RankMerger:
    """Symbols left after all merges, for batches of pre-tokens at once."""

    def __init__(self, path: str):
        self.rules = rules(path)
        self.remembered = Remembered(self.work)

    def work(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        long = lengths > LONG
        counts = lengths.copy()
        for merge, chosen in ((self.merge, np.flatnonzero(~long)), (self.merge_long, np.flatnonzero(long))):
            if len(chosen):
                counts[chosen] = merge(np.frombuffer(b"".join(raw[i] for i in chosen.tolist()), np.uint8), lengths[chosen])
        return counts.astype(np.uint32), np.ones(len(texts), dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 for a pair that is not in the vocabulary."""
        r = self.rules
        key = left * r.size + right
        at = np.minimum(np.searchsorted(r.keys, key), len(r.keys) - 1)
        return np.where(r.keys[at] == key, r.rank[at], -1)

    def merge_long(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``merge`` for long sequences: the ranks are gone through once, in order,
        for all sequences together, and a step touches only the pairs of its rank.

        Symbols are linked to the next one in their sequence. Pairs wait with their
        rank; those of the ranks just ahead stand in lists by rank, the others in one
        heap of arrays that is opened a sixteenth at a time. A pair that has changed
        since is passed over. A merge may make a pair of a lower rank only in a file
        whose merges come before their parts; such a pair is next.
        """
        r, n = self.rules, len(data)
        symbol = np.append(r.byte_id[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # n: no symbol
        ends = np.cumsum(lengths)
        after[ends - 1] = n
        before[ends - lengths] = n
        live = np.append(np.ones(n, dtype=bool), False)
        lists: dict[int, list[np.ndarray]] = {}
        ahead: list[int] = []
        border = 0  # ranks below it are in the lists

        def wait(at: np.ndarray) -> None:
            at = at[after[at] < n]
            rank = self.ranks(symbol[at], symbol[after[at]])
            known = rank >= 0
            rank, at = rank[known], at[known]
            near = rank < border
            if near.any():
                enlist(rank[near], at[near])
            if not near.all():
                later.append((rank[~near], at[~near]))

        def enlist(rank: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for x, some in zip(rank[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
                if x not in lists:
                    heapq.heappush(ahead, x)
                    lists[x] = []
                lists[x].append(some)

        later: list[tuple[np.ndarray, np.ndarray]] = []
        wait(np.flatnonzero(live))
        while ahead or later:
            if not ahead:
                rank, at = (np.concatenate(parts) for parts in zip(*later, strict=True))
                later.clear()
                border = int(np.partition(rank, len(rank) >> 4)[len(rank) >> 4]) + 1
                near = rank < border
                if not near.all():
                    later.append((rank[~near], at[~near]))
                enlist(rank[near], at[near])
            x = heapq.heappop(ahead)
            at = np.concatenate(lists.pop(x))
            left, right = divmod(int(r.pair[x]), r.size)
            at = np.unique(at[live[at] & (symbol[at] == left) & (symbol[after[at]] == right)])
            if not len(at):
                continue
            if left == right:  # of a run of overlapping pairs, the 1st, 3rd, ... merge
                index = np.arange(len(at))
                opens = np.append(True, after[at[:-1]] != at[1:])
                at = at[((index - np.maximum.accumulate(np.where(opens, index, 0))) & 1) == 0]
            gone = after[at]
            symbol[at] = r.merged[x]
            live[gone] = False
            after[at] = after[gone]
            before[after[at]] = at  # what lands on n is never read
            ahead_of = before[at]
            wait(np.unique(np.concatenate([ahead_of[ahead_of < n], at])))
        return np.add.reduceat(live[:n].astype(np.int64), ends - lengths)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of surviving symbols of ragged byte sequences.

        All live sequences step together: the lowest rank among the adjacent
        pairs of each is found, and every such pair of that sequence becomes
        one symbol. Of overlapping equal pairs (as in aaa) every other one
        counts, from the left. A sequence without a known pair is done.
        """
        r = self.rules
        symbol = r.byte_id[data]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        result = lengths.copy()
        while len(symbol) > 1:
            key = symbol[:-1] * r.size + symbol[1:]
            at = np.minimum(np.searchsorted(r.keys, key), len(r.keys) - 1)
            known = (r.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.where(known, r.rank[at], np.iinfo(np.int64).max)
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            padded = np.r_[rank, np.iinfo(np.int64).max]
            lowest = np.minimum.reduceat(padded, heads)
            sizes = np.diff(np.r_[heads, len(symbol)])
            least = np.repeat(lowest, sizes)
            hit = np.r_[known & (rank == least[:-1]), False]
            # of a run of overlapping hits, the 1st, 3rd, ... merge
            index = np.arange(len(hit))
            run = hit & ~np.r_[False, hit[:-1]]
            opened = np.maximum.accumulate(np.where(run, index, -1))
            hit &= ((index - opened) & 1) == 0
            where = np.flatnonzero(hit)
            symbol[where] = r.made[at[where]]
            live = np.repeat(lowest < np.iinfo(np.int64).max, sizes)
            result[owner[heads]] = np.add.reduceat(1 - np.r_[False, hit[:-1]].astype(np.int64), heads)
            keep = live & ~np.r_[False, hit[:-1]]
            symbol, owner = symbol[keep], owner[keep]
        return result

    def count(self, column) -> np.ndarray:
        """Tokens of each text."""
        place, part, row, after = placed(column, self.rules.special, self.remembered)
        n = len(column)
        counts = self.remembered.flat[self.remembered.start[place]].astype(np.int64)
        per_part = np.bincount(part, weights=counts, minlength=len(row)) if len(part) else np.zeros(len(row))
        per_part = per_part + (after >= 0)
        return np.bincount(row, weights=per_part, minlength=n).astype(np.int64) if len(row) else np.zeros(n, np.int64)


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """This worker's encoder, kept between tasks."""
    key = ("encoder", path, remembered)
    if key not in _state:
        _state[key] = Encoder(path, remembered)
    return _state[key]


def merger(path: str) -> RankMerger:
    if ("merger", path) not in _state:
        _state["merger", path] = RankMerger(path)
    return _state["merger", path]


def encoded(batches: Iterator, path: str, remembered: int = REMEMBERED) -> Iterator[tuple]:
    """(batch, ids, offsets) for slices of record batches with a text column."""
    own = encoder(path, remembered)
    for batch in ta.slices(batches):
        yield batch, *own.encode(batch.column(batch.schema.get_field_index("text")))
