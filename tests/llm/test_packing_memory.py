"""What a worker holds while it packs."""

from __future__ import annotations

import random

import pyarrow as pa
import public_tokenizers

from shelflens.llm import binary_packing, queries


def test_a_worker_gives_back_what_a_slice_needed(monkeypatch):
    """Slices of 2 MB at most; the memory of one is given back before the next is encoded."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeghilmnoprstuvé.,", k=rng.randint(2, 9))) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(texts)], names=["doc_id", "text"])

    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool = Pool()
    monkeypatch.setattr(binary_packing.pa, "default_memory_pool", lambda: pool)
    encoder = binary_packing.WordEncoder(public_tokenizers.path(queries.TOKENIZER))
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    seen = []
    for part in binary_packing._pieces(iter([batch]), encoder, 2048, 1, names):
        seen.append((pool.released, set(part.column(0).to_pylist())))
    assert [n for n, _ in seen] == list(range(1, len(seen) + 1)) and pool.released == len(seen) + 1
    assert sum(len(ids) for _, ids in seen) == 1200
    assert all(sum(len(texts[i].encode()) for i in ids) <= 2 << 20 for _, ids in seen)
