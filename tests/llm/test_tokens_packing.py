"""Encoding against a public implementation; packing against its own constraints."""

import base64
import random
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

from wayfold.llm import packing, tokens

rnd = random.Random(2)
TEXTS = [None, "", " ", "a" * 3000, "ㅋ" * 2000, "  \n\n x  ", "don't <|endoftext|> 안녕하세요​😀", " " * 3000, "한글 English 혼합 1234567 !!!???"] + [
    "".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(0xAC00, 0xD7A3), rnd.randint(0x80, 0x2FFF)])) for _ in range(rnd.randint(1, 50))) for _ in range(300)
]


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.load_vocabulary()


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_public_encoder(vocabulary, public):
    assert vocabulary.encode_batch(TEXTS) == [public.encode_ordinary(t) if t else [] for t in TEXTS]
    assert 0 < vocabulary.merged_words < vocabulary.new_words


def test_pairs_are_compatible_exactly_if_merging_keeps_them(vocabulary):
    back = {v: k for k, v in vocabulary.ranks.items()}
    a, b = (np.array([rnd.randrange(vocabulary.n) for _ in range(3000)]) for _ in range(2))
    want = [vocabulary.merge(back[x] + back[y]) == (x, y) for x, y in zip(a, b)]
    assert vocabulary.compatible(a, b).tolist() == want


def test_encode_dataframe(spark, public):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS[:30])] + [(0, TEXTS[0], "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = tokens.encode(df).collect()
    assert len(got) == 31 and {r.doc_id: r.ids for r in got} == {i: public.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS[:30])}
    assert tokens.encode(df.limit(0)).count() == 0


def test_few_size_patterns_cover_need():
    sizes, need = np.array([90, 60, 45, 30]), np.array([13, 40, 55, 71])
    plan = packing.few_size_patterns(sizes, need, 100)
    assert all((p * sizes).sum() <= 100 for p, _ in plan)
    assert (sum(p * n for p, n in plan) == need).all()
    assert sum(n for _, n in plan) <= 13 + 40 + 28 + 10


@pytest.mark.parametrize("capacity", [100, 1000])
def test_packing_is_whole_and_tight(spark, capacity):
    sizes = [0, 0, None, 100, 250, 1000, 1] + [rnd.randint(1, 99) for _ in range(500)] + [50] * 300
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long")
    rows = packing.pack(df, capacity, shard_items=400).collect()
    per_item, used = defaultdict(list), defaultdict(int)
    for r in rows:
        per_item[r.item_id].append((r.part_no, r["size"]))
        used[r.container_id] += r["size"]
    assert max(used.values()) <= capacity
    for i, n in enumerate(sizes):
        parts = sorted(per_item[i])
        assert [p for p, _ in parts] == list(range(len(parts))) and sum(s for _, s in parts) == (n or 0)
        assert len(parts) == max(1, -(-(n or 0) // capacity))
    total = sum(n or 0 for n in sizes)
    assert len(used) <= total / capacity * 1.08 + 6  # few items: rounding within a group and three shards cost a little


def test_packing_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert packing.pack(df, 10).count() == 0
    zero = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, n_tokens long")
    assert {(r.container_id, r.item_id) for r in packing.pack(zero, 10).collect()} == {(0, 1), (0, 2)}
