"""Filling in the middle."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from brute import AWKWARD, SCHEMA, awkward

from climagrid.llm import infilling


def _cuts(texts, first, second):
    array = pa.array(["before", *texts], pa.string()).slice(1)
    data, n, one, two, offsets, (cut, resume) = infilling.cut_points(array, np.array(first), np.array(second))
    raw = data.tobytes()
    pieces = zip(offsets[:-1], cut, resume, offsets[1:], strict=True)
    return n.tolist(), one.tolist(), two.tolist(), [
        (raw[a:b].decode(), raw[b:c].decode(), raw[c:d].decode()) for a, b, c, d in pieces
    ]


def test_cuts_equal_those_by_characters():
    draw = random.Random(13)
    for _ in range(600):
        texts = ["".join(draw.choice("ab é漢🙂\0") for _ in range(draw.randrange(50))) for _ in range(draw.randrange(1, 7))]
        first, second = ([draw.randrange(1 << 32) for _ in texts] for _ in range(2))
        n, one, two, pieces = _cuts(texts, first, second)
        assert n == [len(t) for t in texts]
        for text, a, b, found, x, y in zip(texts, one, two, pieces, first, second, strict=True):
            assert [a, b] == sorted((x % (len(text) + 1), y % (len(text) + 1)))
            assert found == (text[:a], text[a:b], text[b:])


def test_cuts_of_a_long_text():
    text = "é🙂a" * 700_000
    _, one, two, pieces = _cuts([text, ""], [1_234_567, 1], [2_000_001, 2])
    assert (one, two) == ([1_234_567, 0], [2_000_001, 0])
    assert pieces == [(text[:1_234_567], text[1_234_567:2_000_001], text[2_000_001:]), ("", "", "")]


def _expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_awkward_rows(spark):
    markers = ["<P>", "a<S>b", "<M", "<P><", "<<P", "P>S>M>", "< P >", "\n<M>\n", "<<<<<<<<<<"]
    rows = AWKWARD + [(100 + i, t, "en", "a") for i, t in enumerate(markers * 20)]
    found = infilling.restore(infilling.fill_in_middle(awkward(spark, rows))).collect()
    key = lambda r: str(r)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found]
    assert sorted(got, key=key) == sorted(((i, *_expected(i, t), t or "") for i, t, _, _ in rows), key=key)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert infilling.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rates_are_parameters(spark):
    docs = awkward(spark)
    assert {r.form for r in infilling.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    forms = {r.form for r in infilling.fill_in_middle(docs, rate=100, suffix_first=100).collect() if r.n}
    assert forms == {"spm"}
