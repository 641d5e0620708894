"""Near duplicates and shared lines."""

import hashlib
import random

import duckdb
import pytest
from brute import AWKWARD, BLANKS, SCHEMA, SHARED, ascii_lower, awkward, components, shingles

from climagrid.llm import line_dedup, minhash
from climagrid.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def _oracle(name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    return names, found.fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    names, rows = _oracle(name)
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(rows)


def _edited(words, draw, share):
    return [draw.choice("abcdefgh") * 3 if draw.random() < share else w for w in words]


@pytest.fixture(scope="module")
def family():
    """Copies and near copies of a few texts, a passage in many, and unrelated texts."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("etaoinshr") for _ in range(4))
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(n)] for n in (6, 30, 47, 90, 300)]
    texts = []
    for base in bases:
        texts += [" ".join(base)] * 3 + [" ".join(base).upper()]
        texts += [" ".join(_edited(base, draw, s)) for s in (0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(8)]
    for i in range(60):  # share 60 words, little else
        texts.append(" ".join([word() for _ in range(30 + i)] + passage + [word() for _ in range(30)]))
    chain = [word() for _ in range(100)]  # each linked with the next only
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[5:] + [word() for _ in range(5)]
    texts += ["", "one", "one two", "ONE two", None, "a b c d e"]
    draw.shuffle(texts)
    return list(enumerate(texts, start=3))


@pytest.mark.parametrize("list_size", [1, 64])  # with 1, all lists are drawn anew
def test_components_equal_brute_force(spark, family, list_size):
    expected = components(family)
    docs = spark.createDataFrame(family, "doc_id bigint, text string")
    rows = minhash.near_duplicates(docs, list_size=list_size)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows.collect()}
    assert found == {i: (len(shingles(t)), expected[i], expected[i] == i) for i, t in family}


def test_near_duplicates_of_awkward_rows(spark):
    rows = minhash.near_duplicates(awkward(spark)).collect()
    found = sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in rows)
    linked = {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10}
    assert [(i, c, k) for _, i, c, k in found] == [
        *[(i, linked[i], linked[i] == i) for i in (1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10)], (None, None, True)
    ]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def _kept_lines(docs, least=10):
    key = lambda line: ascii_lower(line.strip(BLANKS))
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        gone = [i is not None and min(holders.get(key(x), {i})) < i for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i is None, i, len(lines), sum(gone), kept))
    return sorted(out)


def test_lines_of_awkward_rows(spark):
    extra = [
        (11, f"  {SHARED}\t\n{SHARED}\nown line of eleven\nown line of eleven\nÉtude numéro un", "fr", "a"),
        (12, "étude numéro un\nÉTUDE NUMÉRO UN\nÉtude numéro un\n\nlast", "fr", "a"),
        (-1, "short\n" + SHARED + "\nshort", "en", "a"),
    ]
    rows = AWKWARD + extra
    docs = awkward(spark, rows)
    result = line_dedup.dedup_lines(docs)
    assert result.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    found = sorted((r.doc_id is None, r.doc_id, r.n_lines, r.n_dropped, r.text) for r in result.collect())
    assert found == _kept_lines([(i, t) for i, t, _, _ in rows])
    assert {r.pos for r in result.collect()} == {"pos"}
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_higher_threshold_counts_documents(spark):
    rows = [(i, f"line number {n}\nline number {n}") for i in range(1, 5) for n in range(i)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = {r.doc_id for r in line_dedup.dropped_lines(docs, min_docs=4).collect()}
    assert gone == {2, 3, 4}  # number 0 is in all four, the others in fewer


def test_queries_hash_what_is_left(spark):
    row = QUERIES["op9_line_dedup"](spark, SF).where("n_dropped = 0").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
