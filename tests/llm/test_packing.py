import random
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest

from civitally.llm import packing
from civitally.llm.queries import QUERIES, tokenizer_path
from civitally.llm.tokens import PieceCache, shared_cache

SF = "/root/testdata/sf0.001"


@lru_cache(1)
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(rows, docs):
    """Every token is in exactly one place; returns the number of sequences."""
    want = []
    for doc, text in docs:
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            want.append((doc, k, at, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(places), -(-sum(w[3] for w in want) // 2048)


def test_query_is_a_full_tight_packing(spark, documents):
    n, least = check(QUERIES["op9_packing"](spark, SF).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert n <= least + 1


def test_awkward_rows(docs_of, clashing, ws):
    rows = [(1, None), (2, ""), (3, "Hello, wörld <|endoftext|>"), (3, "Hello, wörld <|endoftext|>"), (None, "x"), (4, "ab, " * 9000)]
    check(packing.pack(clashing(docs_of(rows)), ws, tokenizer_path()).collect(), rows)


def test_empty_table(docs_of, ws):
    assert packing.pack(docs_of([]), ws, tokenizer_path()).count() == 0


@pytest.mark.parametrize("block, slack", [(40, 1.05), (10_000, 1.02)])
def test_levels_lose_nothing_and_pack_tightly(spark, ws, block, slack):
    """Blocks of 40 pieces have few choices; they are there for the levels."""
    rng = random.Random(1)
    sizes = [(i, rng.choice([2048, rng.randint(1, 900), rng.randint(1, 2047)])) for i in range(1500)]
    placed = packing.assign(spark.createDataFrame(sizes, "uid long, length long"), ws, block=block).collect()
    assert sorted(r.uid for r in placed) == list(range(1500))
    size, bins = dict(sizes), {}
    for r in placed:
        bins.setdefault(r.sequence_id, []).append((r.offset, size[r.uid]))
    assert all(sum(n for _, n in b) <= 2048 for b in bins.values())
    assert len(bins) <= -(-sum(size.values()) // 2048) * slack + 2


def test_pieces_that_fill_no_bin_end(spark, ws):
    sizes = spark.createDataFrame([(i, 1100) for i in range(500)], "uid long, length long")
    assert packing.assign(sizes, ws, block=50).select("sequence_id").distinct().count() == 500


def test_ids_of_pieces_are_ids_of_texts():
    """Whatever the cache has forgotten, keeps of its older half, or never holds."""
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "'re", "'LL", "don't", "é", *"aZ9 .,'s\t\n\x0b\x0c\r\x1c\x1f\x85\xa0 éßİΣς中́😀\x00²½ſŉĿ×÷ªǅ"]
    rng = random.Random(3)
    for limit in (1, 20_000, 1 << 26):
        cache = PieceCache(tokenizer_path(), limit)
        for _ in range(1500):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
            assert cache.packed_ids(text.encode()) == ids_of(text).tobytes()


def test_plain_letters_and_marks_are_cut_like_the_tokenizer_does():
    rng, cache = random.Random(5), PieceCache(tokenizer_path())
    plain = [chr(c) for c in (*range(1, 128), *range(0xC0, 0x180))]
    for _ in range(4000):
        text = "".join(rng.choice(plain) for _ in range(rng.randint(1, 8)))
        assert cache.packed_ids(text.encode()) == ids_of(text).tobytes()


def test_the_cache_is_bounded_and_shared(spark):
    cache = PieceCache(tokenizer_path(), 200_000)
    for i in range(3000):
        cache.packed_ids(f"word{i} other{i}".translate(str.maketrans("0123456789", "abcdefghij")).encode())
        assert cache.held <= 100_000 and len(cache.known) + len(cache.older) < 2000
    assert shared_cache(tokenizer_path()) is shared_cache(tokenizer_path())


def test_crossover_keeps_every_member():
    rng = random.Random(2)
    size = [rng.randint(1, 2048) for _ in range(300)]
    one, two = (packing.first_solution(size, 2048, rng, s) for s in (False, True))
    child = packing.crossover(one, two, size, 2048, rng)
    assert sorted(i for b in child for i in b) == list(range(300))
    assert all(sum(size[i] for i in b) <= 2048 for b in child)


def test_blocks_above_the_bound_evolve_in_every_epoch(monkeypatch):
    """Best fit does not meet the bound of these pieces; no epoch may end after a handful of generations."""
    import pandas as pd

    made = []
    monkeypatch.setattr(packing, "crossover", lambda *a, f=packing.crossover: (made.append(1), f(*a))[1])
    rng, size = random.Random(0), []
    for _ in range(60):
        one = rng.randint(500, 900)
        two = rng.randint(400, 1748 - one)
        size += [one, two, 2048 - one - two]
    frame = pd.DataFrame({"uid": range(len(size)), "length": size})
    epochs = []

    class Grouped:
        """Stands for a table of one block; its groups are handed to the epochs as they are."""

        def withColumn(self, *_):
            return self

        groupBy = withColumn

        def applyInPandas(self, run, _):
            epochs.append(run)

    packing._islands(Grouped(), 2048)
    packing._next_epoch(Grouped(), 2048, last=True)
    first = epochs[0]((0, 0), frame)
    assert len(made) == packing.GENERATIONS >= 50
    epochs[1]((0,), pd.concat([first, epochs[0]((0, 1), frame)]).drop_duplicates(["uid", "parent"]))
    assert len(made) == 3 * packing.GENERATIONS


def test_rows_of_a_solution_against_a_plain_loop():
    """Rows tell where every member lies, and the solutions of a block come back from them."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"uid": np.sort(rng.choice(10**12, 500, replace=False)), "length": rng.integers(1, 2049, 500)})
    size = frame["length"].tolist()
    solutions = [packing.first_solution(size, 2048, random.Random(4), s) for s in (False, True)]
    made = []
    for parent, bins in enumerate(solutions):
        rows = packing._rows(frame, bins, {"block": 7}).assign(island=0, parent=parent)
        want = []
        for number, members in enumerate(bins):
            at, full = 0, sum(size[i] for i in members)
            for i in members:
                want.append((frame["uid"][i], size[i], number, at, full, 7))
                at += size[i]
        assert list(rows[["uid", "length", "bin", "offset", "fill", "block"]].itertuples(index=False, name=None)) == want
        made.append(rows)
    mixed = pd.concat(made).sample(frac=1, random_state=1)
    first, found = packing._solutions(mixed)
    assert first["uid"].tolist() == frame["uid"].tolist()
    assert [sorted(map(sorted, bins)) for bins in found] == [sorted(map(sorted, bins)) for bins in solutions]
