"""Token ids, token files and packing: exact against the tokenizers library, round trips, full sequences."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_rows import ROWS
from tokenizers import Tokenizer

from tidegauge.llm.kernel import slices
from tidegauge.llm.packing import Plan, packed
from tidegauge.llm.token_files import TokenFile, read_dictionary, read_token_files, token_files, write_token_files
from tidegauge.llm.tokens import Encoder
from tidegauge.scratch import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encoded(encoder, texts, limit):
    out = []
    for part in slices(pa.array(texts, pa.string()), limit):
        ids, counts = encoder.encode(part)
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


@pytest.mark.parametrize("memory", [50, 500_000])
def test_ids_are_those_of_the_library(memory, monkeypatch):
    monkeypatch.setattr("tidegauge.llm.tokens.MEMORY", memory)
    monkeypatch.setattr("tidegauge.llm.tokens.RECENT", memory // 100)
    r = random.Random(1)
    letters = "aZé×'s.,<|> \n1²٣é≠—Σíñll'd́한"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["it's don't!'s 'sound a≠b é,é ,é <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>!<|startoftext|>s", "", None, "a\x1cb \x00", "ABC's'S ß!ẞ", "<|endoftext|"]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoded(Encoder(PATH), texts, 2000) == want


def test_token_files_round_trip(spark, edges):
    folder = fresh_folder(spark, "tokens")
    files = write_token_files(edges, PATH, folder)
    got = read_token_files(files, folder).collect()
    want = [(i, [*ids_of(t), 2]) for i, t in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i is None, i or 0, len(x), crc(x)) for i, x in want)
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == np.cumsum([0, *(r["n_tokens"] for r in by_start)])[:-1].tolist()
    assert [r["doc_id"] for r in by_start] == [i for i, _ in want]


def test_one_document_is_read_alone_and_the_dictionary_is_checked(spark, edges):
    folder = fresh_folder(spark, "tokens")
    for row in write_token_files(edges, PATH, folder).collect():
        file = TokenFile(row["uri"], read_dictionary(folder))
        last = len(file) - 1
        assert len(file) == row["docs"] and len(file.ids(last)) == file.counts[last] and file.ids(last)[-1] == 2
        with pytest.raises(ValueError, match="another dictionary"):
            TokenFile(row["uri"], b"other")


def test_token_files_of_nothing(nothing):
    assert token_files(nothing, PATH).count() == 0


def test_pieces_carry_the_right_ids_and_fill_sequences(edges, nothing):
    got = packed(edges, PATH).collect()
    want = []
    for i, t in ROWS:
        ids = [*ids_of(t), 1]
        want += [(i is None, i or 0, k // 4096, k, len(ids[k : k + 4096]), crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:5]) for r in got) == sorted(want)
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], 4096)
    assert packed(nothing, PATH).count() == 0


def check_sequences(places, capacity):
    by = defaultdict(list)
    for sequence, offset, length in places:
        by[sequence].append((offset, length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(30))
def test_plans_are_whole_and_tight(seed):
    r = random.Random(seed)
    capacity = r.choice([12, 60, 1000])
    lengths = [r.randint(1, r.choice([capacity, capacity // 3, max(1, capacity // 10)])) for _ in range(r.choice([1, 30, 2000]))]
    counts = defaultdict(int)
    ranks = []
    for n in lengths:
        ranks.append(counts[n])
        counts[n] += 1
    plan = Plan(dict(counts), capacity)
    sequence, offset = plan.lookup()(np.array(lengths), np.array(ranks))
    used = check_sequences(list(zip(sequence.tolist(), offset.tolist(), lengths, strict=True)), capacity)
    assert used == plan.sequences
    # Best fit of items in descending order, one by one, needs no fewer.
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((capacity if fit is None else fit) - n)
    assert used <= len(gaps) + 1


def most_pairs(items, capacity):
    """The fewest sequences for items above a third of the capacity, by trying all partners."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    return 1 + min([most_pairs(rest, capacity), *(most_pairs(rest[:i] + rest[i + 1 :], capacity) for i, b in enumerate(rest) if first + b <= capacity)])


@pytest.mark.parametrize("seed", range(20))
def test_large_items_are_matched_best(seed):
    r = random.Random(seed)
    items = sorted((r.randint(35, 100) for _ in range(7)), reverse=True)
    counts = defaultdict(int)
    for n in items:
        counts[n] += 1
    assert Plan(dict(counts), 100).sequences == most_pairs(items, 100)
