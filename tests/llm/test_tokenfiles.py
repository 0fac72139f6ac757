"""Huffman codes against plain Huffman trees, and token files against the tokenizer itself."""

import heapq
import itertools
import random
import zlib

import numpy as np
import pytest

import awkward
from tilewright.llm import huffman as H
from tilewright.llm import tokenfiles as T
from tilewright.llm.packing import vocabulary_path


def plain_cost(counts):
    """Bits of an optimal prefix code without a limit, by merging the two lightest trees."""
    heap, number = [(int(n), i) for i, n in enumerate(counts) if n], itertools.count(len(counts))
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], next(number)))
    return cost


def plain_limited(counts, limit):
    """Least bits with codes of ``limit`` at most, over all length profiles in order of weight (few symbols)."""
    weights, best = sorted((n for n in counts if n), reverse=True), None
    for profile in itertools.combinations_with_replacement(range(1, limit + 1), len(weights)):
        if sum(2.0 ** -k for k in profile) <= 1:
            cost = sum(n * k for n, k in zip(weights, profile))
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_lengths_are_optimal_within_the_limit(seed):
    rng = random.Random(seed)
    counts = np.array([int(rng.random() ** 6 * 10_000) for _ in range(rng.choice((2, 3, 40, 300)))] + [5, 0, 7])
    assert int((counts * H.code_lengths(counts, 24)).sum()) == plain_cost(counts)
    few = np.array([rng.choice((0, 1, 2, 40, 3000)) for _ in range(6)] + [1, 9])
    for limit in (3, 4, 5):
        lengths = H.code_lengths(few, limit)
        assert lengths.max() <= limit and int((few * lengths).sum()) == plain_limited(few.tolist(), limit)


def test_codes_are_canonical_and_prefix_free():
    lengths = H.code_lengths(np.array([3, 0, 900, 2, 2, 2, 77, 78, 500, 1]), 5)
    codes = H.canonical(lengths)
    words = sorted((int(n), i, format(int(c), f"0{n}b")) for i, (n, c) in enumerate(zip(lengths, codes)) if n)
    assert [w for _, _, w in words] == sorted(w for _, _, w in words) and not any(a[2] != b[2] and b[2].startswith(a[2]) for a in words for b in words)


@pytest.mark.parametrize("counts", [[1], [255, 256, 257], [70_000], [1, 1, 3000, 2, 256, 512, 513]])
def test_texts_decode_from_any_checkpoint(counts):
    rng, counts = np.random.default_rng(sum(counts)), np.array(counts)
    ids = (rng.random(counts.sum()) ** 8 * 50_257).astype(np.uint32)
    codec = H.Codec(H.code_lengths(np.bincount(ids)))
    data, stops, checkpoints = codec.encode(ids, np.cumsum(counts))
    sizes = H.lanes(counts)
    assert sizes.sum() == counts.sum() and len(sizes) == len(checkpoints) and len(data) == stops[-1]
    at = checkpoints + 8 * np.repeat(np.append(0, stops[:-1]), -(-counts // H.STRIDE))
    assert (codec.decode(data.tobytes(), at, sizes) == ids).all()
    first = np.cumsum(sizes) - sizes
    for k in range(0, len(at), 7):
        assert (codec.decode(data.tobytes(), at[k:k + 1], sizes[k:k + 1]) == ids[first[k]:first[k] + sizes[k]]).all()


def expected(rows):
    from tokenizers import Tokenizer

    encoder, start, out = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(encoder.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1 << 16, 700])
def test_files_give_back_what_the_tokenizer_gave(spark, tmp_path, block_ids):
    T.write_token_files(awkward.documents(spark), f"{tmp_path}/t", block_ids=block_ids, part_ids=40_000)
    got = sorted(map(tuple, T.with_crc32(T.read_token_files(spark, f"{tmp_path}/t")).collect()), key=lambda r: r[1])
    want = expected(awkward.rows())
    ids = lambda rows: [r[0] for r in rows]
    assert ids(got) == ids(want) and sorted(g[2:] for g in got) == sorted(w[2:] for w in want)
    starts, once = {}, {i for i in ids(want) if ids(want).count(i) == 1}
    for i, start, *rest in want:
        starts[i] = (start, *rest)
    assert all((start, *rest) == starts[i] for i, start, *rest in got if i in once)
    assert [g[1] for g in got] == [0, *itertools.accumulate(g[2] for g in got)][:-1]  # also where ids repeat
    blocks = spark.read.parquet(f"{tmp_path}/t/blocks")
    assert blocks.count() > (8 if block_ids < 1000 else 3) and {p.name for p in (tmp_path / "t").iterdir()} == {"codes", "blocks", "parts"}


def test_any_range_of_ids_can_be_read(spark, tmp_path):
    T.write_token_files(awkward.documents(spark), f"{tmp_path}/t", block_ids=3000, part_ids=100_000)
    rows = sorted(T.read_token_files(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    for start, stop in ((0, 1), (250, 2700), (2999, 3002), (5000, 70_000), (len(ids) - 3, len(ids) + 50), (40, 40), (len(ids), len(ids) + 9), (0, len(ids))):
        got = sorted(map(tuple, T.read_id_range(spark, f"{tmp_path}/t", start, stop).collect()))
        assert [p for p, _ in got[:1]] == ([start] if start < min(stop, len(ids)) else [])
        assert np.array_equal(np.frombuffer(b"".join(bytes(x) for _, x in got), "<u4"), ids[start:stop])
    assert T.read_id_range(spark, f"{tmp_path}/t", 250, 2700).count() < 4


def test_empty_table_and_one_id(spark, tmp_path):
    T.write_token_files(awkward.empty(spark), f"{tmp_path}/e")
    assert T.read_token_files(spark, f"{tmp_path}/e").count() == 0
    T.write_token_files(spark.createDataFrame([(4, ""), (3, None)], "doc_id long, text string"), f"{tmp_path}/o")
    got = T.with_crc32(T.read_token_files(spark, f"{tmp_path}/o")).orderBy("doc_id").collect()
    assert [tuple(r)[:3] for r in got] == [(3, 0, 1), (4, 1, 1)]
