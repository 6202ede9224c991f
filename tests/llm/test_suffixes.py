import random
from hashlib import sha256
from types import SimpleNamespace

import pytest

from civitally.llm import suffixes as sx
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def expected(rows):
    """Whoever holds a window first keeps it; rows of one id and text are one document."""
    unique = sorted({(d is None, d or 0, __import__("hashlib").md5((t or "").encode()).digest(), (t or "").encode()) for d, t in rows})
    seen, answer = set(), {}
    for none, d, _, text in unique:
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            w = text[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        answer[None if none else d, text] = (len(text), sum(gone), spans, sha256(kept).hexdigest())
    return sorted(((d, *answer[d, (t or "").encode()]) for d, t in rows), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_every_window(spark, documents):
    want = expected([(r.doc_id, r.text) for r in documents.collect()])
    assert found(QUERIES["op5_suffixes"](spark, SF)) == want
    assert any(0 < r[2] < r[1] for r in want)


@pytest.fixture
def mixed():
    """Passages in many surroundings, periods, copies, and edges at every offset."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    passages = [word(n) for n in (60, 99, 100, 101, 180, 400)]
    rows = []
    for i in range(120):
        text = word(rng.randint(0, 150)) + rng.choice(passages)[rng.randint(0, 30) :] + word(rng.randint(0, 90)) + rng.choice(passages)
        rows.append((i, text))
    rows += [(200, "a" * 350), (201, "ab" * 200), (202, "x" * 50 + "ab" * 120), (203, rows[5][1]), (4, rows[9][1]), (204, "a" * 99)]
    rows += [(205, "hello " * 300), (None, rows[7][1]), (None, word(200)), (206, rows[11][1] + rows[11][1]), (206, rows[11][1] + rows[11][1])]
    rows += [(207, None), (208, ""), (209, word(3000) * 2)]
    new = word(300)  # a document that comes as two rows keeps what a later one repeats
    rows += [(210, new), (210, new), (211, word(20) + new)]
    return rows


@pytest.mark.parametrize("hot", [2000, 3])
@pytest.mark.parametrize("chunk", [1 << 18, 500])
def test_mixed_rows(docs_of, clashing, ws, monkeypatch, mixed, hot, chunk):
    """The way of hot anchors and the cuts of long texts change nothing."""
    for name, value in {"HOT": hot, "CHUNK": chunk, "RUN_BYTES": 20_000, "BUCKET_SPANS": 200, "BUCKET_ANCHORS": 100}.items():
        monkeypatch.setattr(sx, name, value)
    assert found(sx.remove_repeats(clashing(docs_of(mixed)), ws)) == expected(mixed)


def test_empty_table(docs_of, ws):
    assert sx.remove_repeats(docs_of([]), ws).count() == 0


def test_merge_of_runs_compares_no_known_prefix(monkeypatch):
    rng = random.Random(1)
    keys = sorted({bytes(rng.choices(b"ab", k=rng.randint(1, 12))) for _ in range(400)})
    runs = [sorted(rng.sample(keys, rng.randint(1, 60))) for _ in range(11)]
    rows = []
    for run in runs:
        parts, last = [], b""
        for key in run:
            same = sx.common_prefix(last, key, 0)
            parts.append((same, len(key) - same, key[same:], 1, b"d" * 16, 0))
            last = key
        rows.append(SimpleNamespace(**dict(zip(["lcp", "size", "tail", "id", "doc", "start"], sx._packed(parts)))))
    compared = []
    plain = sx.common_prefix
    monkeypatch.setattr(sx, "common_prefix", lambda a, b, known: compared.append(a[:known] == b[:known]) or plain(a, b, known))
    got = [e[0] for e in sx.merged([sx.Run(r) for r in rows])]
    assert got == sorted(k for run in runs for k in run)
    assert all(compared)
