import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketgrain.llm import bpe, common
from marketgrain.llm import op1_repair_ids as repair
from marketgrain.llm import op7_token_counts as counts
from marketgrain.llm import op8_linear_grouping as packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_splitting_and_merging_equal_the_library(library):
    rng = random.Random(3)
    signs = "ab'slmtdrev \n\t19!?é ı漢  "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    import pyarrow as pa

    ids, offsets = bpe.Encoder(PATH).encode(pa.array(texts))
    sizes = bpe.RankMerger(PATH).count(pa.array(texts))
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want
        assert sizes[i] == len(want)


def unbroken(n, letters, seed=5):
    return "".join(random.Random(seed + n).choices(letters, k=n))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def test_long_pre_tokens_equal_the_library(library):
    import pyarrow as pa

    texts = [unbroken(n, LETTERS[:k]) for n in (bpe.LONG, bpe.LONG + 1, 3000) for k in (1, 2, 3, 26)]
    texts += ["ab" * 3000 + "a", "éàü漢字" * 500, "=" * 2001, "x " + "漢" * 900 + " y"]
    sizes = bpe.RankMerger(PATH).count(pa.array(texts))
    assert sizes.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_million_letters_in_seconds(library):
    import time

    import pyarrow as pa

    text, start = unbroken(1_000_000, LETTERS), time.perf_counter()
    sizes = bpe.RankMerger(PATH).count(pa.array([text]))
    assert time.perf_counter() - start < 10
    assert sizes[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_long_words_go_through_files_and_packing(docs, library, spark):
    texts = [unbroken(n, LETTERS) for n in (5_000, 50_000)]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    path = common.scratch(spark, "t")
    repair.write_ids(docs(texts), path, PATH)
    assert [(r["n_tokens"], r["ids_crc32"]) for r in repair.read_index(spark, path).orderBy("start").collect()] == [
        (len(x) + 1, crc(x + [0])) for x in ids
    ]
    pieces = packing.cut(docs(texts), PATH).groupBy("doc_id").sum("length").collect()
    assert sorted(tuple(r) for r in pieces) == [(i, len(x) + 1) for i, x in enumerate(ids)]


def test_counts(odd, library):
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counts.token_counts(odd, PATH).collect())
    want = []
    for r in odd.collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        want.append((r["doc_id"] or -1, len((r["text"] or "").encode()), n, n > 512))
    assert found == sorted(want)


def test_empty_tables(docs, spark):
    none = docs([])
    assert counts.token_counts(none, PATH).collect() == []
    path = common.scratch(spark, "t")
    repair.write_ids(none, path, PATH)
    assert repair.read_index(spark, path).collect() == []
    assert packing.pack(common.stored(packing.cut(none, PATH), "t")).collect() == []


def test_file_round_trip(odd, library, spark):
    path = common.scratch(spark, "t")
    repair.write_ids(odd, path, PATH, block_tokens=500)
    found = [tuple(r) for r in repair.read_index(spark, path).orderBy("start").collect()]
    want = {}
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want.setdefault(r["doc_id"], []).append((len(ids), crc(ids)))
    start = 0
    for doc, at, n, code in found:
        assert at == start
        assert (n, code) in want[doc]
        want[doc].remove((n, code))
        start += n
    assert not any(want.values())
    order = [-1 if f[0] is None else f[0] for f in found]
    assert order == sorted(order)
    some = repair.read_some(spark, path, [9, 101])
    assert some[9] == library.encode("x<|endoftext|> y<|endoftext|><|endoftext|>", add_special_tokens=False).ids + [0]
    assert len(some[101]) > 40_000


def test_grammar_shrinks_and_expands_each_document():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 50, 40)
    lengths = np.array([0, 400, 1, 0, 1200, 3, 900])
    ids = np.resize(phrase, lengths.sum()).astype(np.uint32)
    ids[::17] = 3
    ids[500:700] = 7
    base, left, right, body, ends = repair.grammar(ids, lengths, rounds=6, min_count=2)
    sizes = repair.rule_sizes(base, left, right)
    assert len(body) < len(ids) / 3
    starts, at = np.r_[0, ends[:-1]], np.r_[0, np.cumsum(lengths)]
    for k in range(len(lengths)):
        run = body[starts[k] : ends[k]]
        assert repair.expand(base, left, right, sizes, run).tolist() == ids[at[k] : at[k + 1]].tolist()
        assert sum(sizes[s - base] if s >= base else 1 for s in run) == lengths[k]


def best_fit_decreasing(histogram, capacity):
    import bisect

    spaces, used = [], 0
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            at = bisect.bisect_left(spaces, n)
            if at == len(spaces):
                used, space = used + 1, capacity
            else:
                space = spaces.pop(at)
            bisect.insort(spaces, space - n)
    return used


@pytest.mark.parametrize("seed", range(25))
def test_plans_place_everything_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    histogram = defaultdict(int)
    for _ in range(rng.choice([1, 5, 60, 400])):
        histogram[rng.randint(1, capacity - 1)] += rng.choice([1, 1, 9])
    for groups, small in ((1, 0), (4, 0.1), (16, 0.3), (500, 0.05), (16, 0.5)):
        used, segments = packing.plan(histogram, capacity, groups, small)
        held, ranks = defaultdict(list), defaultdict(list)
        for n, low, high, per, sequence, offset in segments:
            ranks[n] += range(low, high)
            for r in range(low, high):
                held[sequence + (r - low) // per].append((offset + (r - low) % per * n, n))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
        assert len(held) == used
        for row in held.values():
            end = 0
            for offset, n in sorted(row):
                assert offset == end
                end += n
            assert end <= capacity
    assert packing.best_plan(histogram, capacity)[0] <= best_fit_decreasing(histogram, capacity) * 1.01 + 1


def test_packing(odd, library):
    pieces = common.stored(packing.cut(odd, PATH), "t")
    found = packing.pack(pieces).toPandas()
    for r in odd.collect():
        if r["doc_id"] == 102:
            continue
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        own = found[found.doc_id.isna() if r["doc_id"] is None else found.doc_id == r["doc_id"]].sort_values("piece")
        assert own.piece.tolist() == list(range(len(own)))
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() == len(ids)
        assert len(ids) <= 1024 or (own.length[1:] == 1024).all()
        assert [crc(ids[a : a + n]) for a, n in zip(own.start, own.length, strict=True)] == own.ids_crc32.tolist()
    found = found.sort_values(["sequence_id", "offset"])
    before = found.groupby("sequence_id").length.cumsum() - found.length
    assert (before == found.offset).all()
    assert (found.groupby("sequence_id").length.sum() <= 1024).all()
