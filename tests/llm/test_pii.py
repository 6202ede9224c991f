import re
from hashlib import sha256

from civitally.llm import pii
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def fine(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = []
    for k, (kind, pattern) in enumerate(FORMATS.items()):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if fine(kind, m[0])]
    found.sort()
    counts = [sum(f[3] == kind for f in found) for kind in FORMATS]
    return (*counts, sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in found).encode()).hexdigest())


def expected(rows):
    return sorted(((d, *base(t)) for d, t in rows), key=repr)


def found(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def test_query_against_formats(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = expected(rows)
    df = QUERIES["op2_pii"](spark, SF)
    assert found(df) == want
    assert sum(sum(w[1:5]) for w in want) > 5
    for r in df.collect():  # base spans stay among all spans
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert [kinds.count(k) for k in FORMATS] == list(r[1:5])


AWKWARD = [
    (1, None), (2, ""), (3, "a@b.c_d@e.f x@y y@z..q %@-.-"), (4, "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3"),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111"), (6, "+1 (212) 555-0100 +12 +4930123456789012345 +5)("),
    (7, "é😀 mail: jo@exämple.org jo@ex.org +49.30-1234567"), (7, "é😀 mail: jo@exämple.org jo@ex.org +49.30-1234567"),
    (None, "10.0.0.1"), (8, "1" * 60_000), (9, "a" * 60_000 + "@"), (10, "7 " * 30_000), (11, "a@b.c," * 800),
    (12, "x@1.2.3.4 4111111111111111@a.b"), (13, "1.2.3.4" * 3), (14, "+1+2+1234567890"), (15, "a.b@c.d" * 4),
]


def test_awkward_rows(docs_of, clashing):
    assert found(pii.find(clashing(docs_of(AWKWARD)))) == expected(AWKWARD)


def test_empty_table(docs_of):
    assert pii.find(docs_of([])).count() == 0
    assert pii.redact(docs_of([])).count() == 0


def test_redaction_touches_nothing_else(docs_of):
    rows = [(1, "to é a@b.cc, 10.0.0.1!", "en", "s", 21), (2, None, None, None, None), (3, "plain", "en", "s", 5)]
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs_of(rows)).collect()}
    assert got == {1: ("to é [EMAIL], [IP]!", 19), 2: (None, None), 3: ("plain", 5)}


def test_trees_add_spans_by_context(docs_of):
    """Checked formats teach the trees; formats of the same shape are then taken."""
    rows = [(i, f"call me: +1 212 555 {1000 + i} or card 4111-1111-1111-1111 now") for i in range(40)]
    rows += [(100 + i, f"code x{i:03d}-555-{1000 + i}7 and 4111-1111-1111-11{i % 90 + 10}") for i in range(40)]
    rows += [(200 + i, f"phone: 212-555-{1000 + i} please") for i in range(40)]
    rows += [(300 + i, f"part 112-155-{1000 + i} kept") for i in range(40)]
    got = pii.find(docs_of(rows)).where("doc_id >= 200").collect()
    taken = {r.doc_id for r in got if "phone_local:" in r.spans}
    assert taken == set(range(200, 240))
