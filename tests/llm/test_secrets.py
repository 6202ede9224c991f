import random
import re
import time
from collections import Counter
from hashlib import sha256
from math import log2

import pytest

from civitally.llm import secrets
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def base(text):
    text, found = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key += "|[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    counts = [sum(f[1] == k for f in found) for k in range(3)]
    return (*counts, sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in found).encode()).hexdigest())


def expected(rows):
    return sorted(((d, *base(t)) for d, t in rows), key=repr)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def test_query_against_formats(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = QUERIES["op3_secrets"](spark, SF)
    assert found(df) == expected(rows)
    assert any(sum(w[1:4]) for w in expected(rows))


AWKWARD = [
    (1, None), (2, ""), (3, "PassWord = 'abcdefgh' passwd:short Secret:\"=12345678 apikey=x.y-z/+_=9"), (4, "AKIAKIA AKIAAKIAABCDEFGH1 AKIA123"),
    (5, "é😀 token: " + "0a" * 20), (5, "é😀 token: " + "0a" * 20), (None, "f" * 31 + " " + "f" * 32), (6, "ſecret=abcdefghi toKen=abcdefghi"),
    (7, "ab12" * 30_000), (8, "password:" * 5000), (9, "secret= \n abcdefghijk"), (10, "AKIA" * 9000),
]


def test_awkward_rows(docs_of, clashing):
    assert found(secrets.scan(clashing(docs_of(AWKWARD)))) == expected(AWKWARD)


def test_empty_table(docs_of):
    assert secrets.scan(docs_of([])).count() == 0


def test_windows_against_counting_each():
    rng = random.Random(8)
    for limit in (2.5, 3.2, 3.9):
        for _ in range(60):
            text = "".join(rng.choice("ab" if rng.random() < 0.5 else "abcdefghijklmnop0123456789") for _ in range(rng.randint(5, 90)))
            covered = set()
            for i in range(len(text) - secrets.WINDOW + 1):
                counts = Counter(text[i : i + secrets.WINDOW]).values()
                if -sum(n / secrets.WINDOW * log2(n / secrets.WINDOW) for n in counts) >= limit - 1e-12:
                    covered.update(range(i, i + secrets.WINDOW))
            got = [set(range(s, e)) for s, e in secrets.windows_above(text, limit)]
            assert set().union(*got) == covered and sum(map(len, got)) == len(covered)


def test_random_strings_are_added_and_writing_is_not():
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYzq83hkLp"
    spans = secrets.scan_text(f"use {key} here")[4]
    assert spans == f"entropy:4:{4 + len(key)}"
    calm = "internationalization/of/everything 123456789012345678901234567890 123e4567-e89b-12d3-a456-426614174000 AbcEXAMPLEwJalrXUtnFEMI7"
    assert secrets.scan_text(calm)[4] == ""


@pytest.mark.parametrize("part", ["word-", "Word_", "Ab/", "CONST_", "x=", "1a-", "ab12", "-", "EXAMPLE", "Zz9+"])
def test_long_strings_of_parts_take_linear_time(part):
    began = time.process_time()
    for end in ("2024", "word", "", "!"):
        secrets.scan_text(part * 10_000 + end)
    assert time.process_time() - began < 5


def test_slugs_are_no_secrets():
    assert secrets.scan_text("see word-by-word-and-part-by-part-of-a-slug now")[5] == 0
    assert secrets.scan_text("see Path/to/Some_file=named+here-again-and-again now")[5] == 0
