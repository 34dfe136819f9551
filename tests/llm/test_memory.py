"""What a task holds beside its batch of texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tillflow.llm import lm_scoring, near_duplicates, repeats, text


def test_arrays_over_a_slice_are_small():
    letters = np.frombuffer(b"abcdefghij    ", np.uint8)
    column = pa.array([letters[np.random.default_rng(i).integers(0, len(letters), 4000)].tobytes().decode() for i in range(1100)])
    text._POWERS.clear()
    tracemalloc.start()
    try:
        runs = sum(len(repeats.text_runs_of(data, offs, 200)[0]) for _, _, _, data, offs in repeats.long_slices(column, 200))
        peak_runs = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        sets = sum(len(s) for _, _, data, offs in text.text_slices(column) for s in near_duplicates.shingle_sets(data, offs, 2))
        peak_sets = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert runs and sets
    assert max(peak_runs, peak_sets) < 64 << 20, (peak_runs, peak_sets)


def test_counting_a_block_of_texts_is_small():
    words = np.array([f"w{i}" for i in range(60_000)])
    texts = [" ".join(words[np.random.default_rng(i).integers(0, len(words), 700)]) for i in range(1800)]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    assert batch.nbytes > 7 << 20
    text._POWERS.clear()
    tracemalloc.start()
    try:
        sizes = [rows.num_rows for rows in lm_scoring._gram_rows(iter([batch]), 3)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) > 10**6 and max(sizes) <= 1 << 16
    assert peak < 320 << 20, peak


def test_tokens_do_not_depend_on_slices():
    rng = np.random.default_rng(2)
    for sizes in ([0, 3, 0, 5, 900_000, 0, 2, 700_000, 10, 0], [1] * 5, [600_001] + [100] * 9000, [0]):
        data, offs = rng.integers(32, 127, sum(sizes)).astype(np.uint8), np.r_[0, np.cumsum(sizes)].astype(np.int64)
        assert all(np.array_equal(a, b) for a, b in zip(lm_scoring.token_stream(data, offs), lm_scoring._tokens(data, offs)))
