import random
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplens.llm import packing


@pytest.mark.parametrize("seed", range(5))
def test_fullest_against_brute_force(seed):
    rng = random.Random(seed)
    items = [rng.randrange(1, 30) for _ in range(9)]
    for room in range(1, 60):
        best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k)
                   if sum(c) <= room)
        combo = packing.fullest(dict(Counter(items)), room)
        assert sum(k * n for k, n in combo.items()) == best
        assert all(n <= Counter(items)[k] for k, n in combo.items())


@pytest.mark.parametrize("n", [0, 1, 50, 20000])
def test_plan_uses_every_piece_once(n):
    rng = random.Random(n)
    counts = Counter(min(1024, max(1, int(rng.lognormvariate(5.5, 1)))) for _ in range(n))
    used, sequences = Counter(), 0
    for combo, times in packing.plan(dict(counts)):
        assert sum(k * m for k, m in combo.items()) <= 1024
        sequences += times
        for k, m in combo.items():
            used[k] += m * times
    assert used == counts
    least = -(-sum(k * m for k, m in counts.items()) // 1024)
    assert least <= sequences <= least * 1.02 + 2


def test_cut():
    assert packing.cut(1, 1024) == [(0, 1)]
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)]


def test_pack(docs, rows, no_docs):
    got = packing.pack(docs, with_ids=True).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        for k, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            part = ids[start:start + length]
            want[r[0], k, start, length, zlib.crc32(array("I", part).tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(no_docs).count() == 0


def test_slices_keep_all_rows():
    import pyarrow as pa

    from shoplens.llm.common import slices
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500))], ["x"])
    parts = list(slices([batch, batch.slice(0, 0)], 1000))
    assert [p.num_rows for p in parts] == [1000, 1000, 500]
    assert [v for p in parts for v in p.column("x").to_pylist()] == list(range(2500))
