"""Cross-tokenizer alignment."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from brute import AWKWARD, SCHEMA, awkward
from tokenizers import Tokenizer

from climagrid.llm import alignment, units
from climagrid.llm.queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """Tokens, groups and links of a text by the libraries on whole texts and by comparing all tokens."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: bytes([b]) for c, b in units.byte_characters().items()}

    def spans(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends], ends, strict=False))

    def align(text):
        none = 0, 0, 0, [], ""
        if not text:
            return none
        raw = (" " + text).encode()
        a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        of_a = [b"".join(byte[c] for c in tokenizer.id_to_token(i)) for i in a]
        of_b = []
        for piece in map(pieces.id_to_piece, b):
            byte_piece = piece.startswith("<0x") and len(piece) == 6
            of_b.append(bytes([int(piece[3:5], 16)]) if byte_piece else piece.replace("▁", " ").encode())
        if b"".join(of_a) != raw or b"".join(of_b) != raw:
            return none
        at_a, at_b = spans(of_a), spans(of_b)
        links = [
            (x, y) for x, (s, e) in zip(a, at_a, strict=True) for y, (u, v) in zip(b, at_b, strict=True) if s < v and u < e
        ]
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            own_a = ",".join(str(x) for x, (_, e) in zip(a, at_a, strict=True) if low < e <= high)
            own_b = ",".join(str(y) for y, (_, e) in zip(b, at_b, strict=True) if low < e <= high)
            groups.append(f"{own_a}|{own_b}")
        return len(a), len(b), len(groups), sorted(links), ";".join(groups)

    return align


def _scored(plain, docs):
    found = [(i, *plain(t)) for i, t in docs]
    count = Counter(pair for *_, links, _ in found for pair in set(links))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return [
        (i, n_a, n_b, n_groups, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), groups)
        for i, n_a, n_b, n_groups, links, groups in found
    ]


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(11)
    parts = list("ab AB.,'\"\n\t  \x85\x1c\x1fé中1 9#\r\r;){}") + ["'s", "\n\n", "🙂", "don't ", "<|endoftext|>"]
    parts += ["<s>", "</s>", " ", "▁", "<0x41>", "\0", "ﬁ", "\r\n", " \r", " \n", "the ", "hello", "word"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(1500)]
    return texts + [chr(i) + " " + chr(i) for i in range(0, 0xD800, 23)] + ["", None]


def test_units_align_like_whole_texts(plain, mixed):
    low = (1 << alignment.SHIFT) - 1
    for text, found in zip(mixed, alignment.aligner(A, B).align(mixed), strict=True):
        links = sorted((x >> alignment.SHIFT, x & low) for x in np.frombuffer(found[3], "<i8").tolist())
        assert (*found[:3], links, found[4]) == plain(text), repr(text)


def test_joined_units_have_the_ids_of_single_ones():
    side = alignment.aligner(A, B)
    chosen = [" a", " b,", "\n", " c\n", "  d", " é", " <s>", "e", " ", "", " f\x1cg"] * 3
    for one in (side.a, side.b):
        assert one.encode(chosen) == [one.encode([u])[0] for u in chosen]
    # Where tokens do not end with the units, each unit is encoded alone.
    vocabulary = units.ByteLevel(A)
    expected = vocabulary.encode(chosen)
    assert vocabulary.ids(chosen) == expected
    assert units.ids_of_units(chosen, vocabulary.encode, vocabulary._sizes + 1) == expected


@pytest.mark.parametrize("block", [(2, 1 << 21), (1 << 16, 40)])  # few documents, few pairs
def test_scores_equal_brute_force(spark, plain, mixed, block):
    docs = list(enumerate(mixed[:400] + ["the same words"] * 70 + ["again " * 300] * 3 + mixed[:30]))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = alignment.with_scores(*alignment.align(table, A, B, *block)).select(*NAMES)
    assert sorted(map(tuple, found.collect())) == sorted(_scored(plain, docs))


def test_counts_of_pairs(spark, plain, mixed):
    texts = mixed[:200] + ["the same words the same words the"] * 20
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    _, postings = alignment.align(table, A, B, 7)
    links = [plain(t)[3] for t in texts]
    docs, all_links = Counter(p for x in links for p in set(x)), Counter(p for x in links for p in x)
    found = {(r.a_id, r.b_id): (r.docs, r.links) for r in alignment.pair_counts(postings).collect()}
    assert found == {p: (docs[p], all_links[p]) for p in docs}


def test_awkward_rows(spark, plain):
    documents, postings = alignment.align(awkward(spark), A, B)
    found = [tuple(r) for r in alignment.with_scores(documents, postings).select(*NAMES).collect()]
    docs = [(i, t if i != 5 else None) for i, t, _, _ in AWKWARD]  # the long text by its counts below
    short = sorted((r for r in found if r[0] != 5), key=str)
    assert [r[:5] + r[7:] for r in short] == sorted((r[:5] + r[7:] for r in _scored(plain, docs) if r[0] != 5), key=str)
    (long,) = (r for r in found if r[0] == 5)
    text = AWKWARD[6][1]
    own = Tokenizer.from_file(A).encode(" " + text, add_special_tokens=False).ids
    assert long[1] == len(own) and long[4] == long[1] + long[2] - long[3]
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.with_scores(*alignment.align(empty, A, B)).count() == 0


def test_the_query_hashes_groups(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 2000}
    for row in QUERIES["op11_tokenizer_alignment"](spark, SF).collect():
        if row.doc_id in docs:
            groups = plain(docs[row.doc_id])[4]
            assert row.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_a_full_table_hands_on_what_is_still_used(monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_ENTRIES", 6)
    own, learned = alignment.Aligner(alignment.byte_level_side(A), alignment.piece_side(B)), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda found: learned.extend(found) or learn(found))
    texts = [f"uno dos word{i} tres, term{i}" for i in range(20)]
    found = [next(own.align([text])) for text in texts]
    assert learned.count(" uno") == learned.count(" tres,") == 1
    assert len(own._known) + len(own._older) < 30
    assert found == list(alignment.Aligner(own.a, own.b).align(texts))
