"""Token counts, token files and packing against the tokenizers library itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tally.llm.packing import best_configuration, best_fit_packing, places, plan
from tally.llm.pieces import PieceTokens
from tally.llm.scratch import new_path
from tally.llm.token_counts import token_counts
from tally.llm.token_files import read_token_files, token_digests, write_token_files
from tests.llm.awkward import collected, documents, texts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, rows):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in rows], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path):
    rng = random.Random(4)
    parts = ["a", "B", "ß", "é", "é", "1", "½", "Ⅷ", " ", "  ", "\n", "\t", "\r\n", " ", "\x1c", "\x85", "'s", "'ll", "'", "\xa0", "!"]
    parts += ["...", "<|endoftext|>", "<|startoftext|>", "_", "ſ", "İ", "Σ", "ς", "日本", "🎉", "‍", "́", "﻿", "don't", "A.B", "\x01"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    encoder = PieceTokens(path, memo_pieces=500)
    for i in range(0, len(rows), 200):
        some = rows[i : i + 200]
        ids, ends = encoder.ids(pa.array(some))
        expected = ids_of(path, some)
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == expected
        assert encoder.counts(pa.array(some)).tolist() == [len(e) for e in expected]


def test_counts(spark):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in collected(token_counts(documents(spark), BYTES)))
    rows = texts()
    expected = Counter((i, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(rows, ids_of(BYTES, [t for _, t in rows]), strict=True))
    assert got == expected
    assert token_counts(documents(spark, []), BYTES).count() == 0


def test_files_round_trip(spark):
    path = new_path(spark, "test-files")
    write_token_files(documents(spark), path, WORDS, end_id=1, shards=5)
    files = read_token_files(spark, path)
    assert files.count() == len(texts())
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["start"], r["n_tokens"], r["ids_crc32"]) for r in collected(token_digests(files)))
    rows = texts()
    whole = [(-1 if i is None else i, x + [1]) for (i, _), x in zip(rows, ids_of(WORDS, [t for _, t in rows]), strict=True)]
    assert Counter((i, n, c) for i, _, n, c in got) == Counter((i, len(x), crc(x)) for i, x in whole)
    assert [s for _, s, _, _ in got] == np.cumsum([0, *(n for _, _, n, _ in got)])[:-1].tolist()


def test_files_have_dictionary_pages_and_page_indexes(spark, tmp_path):
    import pyarrow.parquet as pq

    write_token_files(documents(spark), f"file://{tmp_path}/files", WORDS, end_id=1, shards=2)
    column = pq.ParquetFile(next((tmp_path / "files").glob("part-*.parquet"))).metadata.row_group(0).column(4)
    assert column.path_in_schema.startswith("ids") and column.has_dictionary_page
    assert column.has_column_index and column.has_offset_index
    assert token_digests(read_token_files(spark, f"file://{tmp_path}/files")).count() == len(texts())


def test_files_of_an_empty_table(spark):
    path = new_path(spark, "test-files")
    write_token_files(documents(spark, []), path, WORDS, end_id=1, shards=3)
    assert token_digests(read_token_files(spark, path)).count() == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    got = collected(best_fit_packing(documents(spark), BYTES, 0, capacity, rounds=40))
    rows = texts()
    whole = defaultdict(list)
    for (i, _), x in zip(rows, ids_of(BYTES, [t for _, t in rows]), strict=True):
        whole[i].append(x + [0])
    pieces = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    expected = Counter()
    for i, documents_of in whole.items():
        for x in documents_of:
            n = -(-len(x) // capacity)
            first = len(x) - (n - 1) * capacity
            for k in range(n):
                start = 0 if k == 0 else first + (k - 1) * capacity
                length = first if k == 0 else capacity
                expected[(i, k, start, length, crc(x[start : start + length]))] += 1
    assert pieces == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r["length"] for r in got)
    assert len(sequences) <= 1.1 * -(-total // capacity) + 1


def test_packing_an_empty_table(spark):
    assert best_fit_packing(documents(spark, []), BYTES, 0).count() == 0


def test_knapsack_prices():
    rng = np.random.default_rng(1)
    for _ in range(30):
        values = np.where(rng.random(21) < 0.4, rng.random(21), 0)
        values[0] = 0
        best = [0.0] * 21
        for room in range(1, 21):
            best[room] = max([best[room - 1], *(best[room - length] + values[length] for length in range(1, room + 1) if values[length])])
        found = best_configuration(values, 20)
        assert sum(length * n for length, n in found.items()) <= 20
        assert np.isclose(sum(values[length] * n for length, n in found.items()), best[20])


def test_plans_hold_each_piece_once_and_come_near_the_bound():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 3000):
        lengths = np.minimum(256, np.exp(rng.normal(4, 0.9, n)).astype(int) + 1)
        histogram = np.bincount(lengths, minlength=257)
        made = plan(histogram, 256, rounds=60)
        held = np.zeros(257, int)
        for configuration, times in made:
            assert sum(length * k for length, k in configuration.items()) <= 256
            for length, k in configuration.items():
                held[length] += k * times
        assert (held == histogram).all()
        assert sum(times for _, times in made) <= 1.02 * lengths.sum() / 256 + 1
        if n:
            table = places(made)
            numbers = np.concatenate([np.arange(c) for c in histogram])
            sequence, offset = table.of(np.repeat(np.arange(257), histogram), numbers)
            assert len({*zip(sequence.tolist(), offset.tolist(), strict=True)}) == n
