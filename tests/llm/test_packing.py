import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessella.llm import packing, tokens
from tests.llm.helpers import documents, none_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_chunked_ids_are_the_tokenizers():
    whole, mine = Tokenizer.from_file(PATH), tokens.ChunkEncoder(PATH)
    parts = [*"abAB.,'s!?<|>ΣσςÅé가", "́", " ", "\x1c", "\x85", "\n", "  ", "\t", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "ﬁ", "１", "9", "»", "Ñ", "ß", "ŉ", " .", "　", "word.", "WORD!!"]
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(mine.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"word{i} x" for i in range(500)).encode()
    expected = tokens.ChunkEncoder(PATH).ids(text)
    monkeypatch.setattr(tokens, "blocks", lambda t: packing_blocks(t, 100))
    assert tokens.ChunkEncoder(PATH).ids(text) == expected
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 3)
    assert tokens.ChunkEncoder(PATH).ids(text) == expected


def packing_blocks(text, size):
    from tessella.llm.blocks import blocks

    found = list(blocks(text, size))
    assert b"".join(found) == text and len(found) > 10
    return found


def test_fullest_combination():
    rng = random.Random(1)
    for _ in range(200):
        counts, room = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}, rng.randint(1, 60)
        reach = {0}
        for n, c in counts.items():
            reach = {s + k * n for s in reach for k in range(c + 1) if s + k * n <= room}
        chosen = packing.fullest(counts, room)
        assert sum(n * k for n, k in chosen) == max(reach) and all(k <= counts[n] for n, k in chosen)


def best_fit(counts, capacity):
    """Sequences that best fit by falling length needs."""
    rooms = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_layout_is_about_as_good_as_best_fit(seed):
    """Each sequence is the fullest one; the number of all is a heuristic's, within a hundredth of another's."""
    rng = random.Random(seed)
    counts = {n: rng.randint(1, 20) for n in rng.sample(range(1, 101), 40)}
    plan, total = packing.layout(dict(counts), 100), sum(n * c for n, c in counts.items())
    assert -(-total // 100) <= plan.sequences <= 1.01 * best_fit(counts, 100) + 1
    assert {n: sum(1 for x in plan.length if x == n) > 0 for n in counts} == dict.fromkeys(counts, True)


def check(spark, df, capacity):
    whole = Tokenizer.from_file(PATH)
    rows = packing.pack(df, PATH, capacity=capacity).collect()
    expected = []
    for r in df.select("doc_id", "text").collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for i in range(0, len(ids), capacity):
            part = ids[i : i + capacity]
            expected.append((r["doc_id"], i // capacity, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda t: (t[0] is None, t)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(expected, key=key)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(e[3] for e in expected)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pack(spark, capacity):
    sequences, total = check(spark, documents(spark), capacity)
    assert sequences <= -(-total // capacity) + 1


def test_empty_table_and_sequences(spark):
    df = documents(spark)
    assert packing.pack(none_of(df), PATH).isEmpty()
    packed = packing.pack(df, PATH, keep_ids=True).cache()
    lengths = {r["sequence_id"]: r["n"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * lengths[r["sequence_id"]]
