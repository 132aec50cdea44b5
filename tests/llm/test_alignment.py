"""Cross-tokenizer alignment against whole-text encodings and all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tabularium.llm import alignment

COLUMNS = "doc_id long, text string, block string, pair string, n_docs string"


@pytest.fixture(scope="module")
def files():
    return alignment.Files.read()


@pytest.fixture(scope="module")
def whole(files):
    """Tokens with their bytes from one call a text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_str(files.a), sentencepiece.SentencePieceProcessor(model_proto=files.b)
    a.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()

    def tokens(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        data = (" " + text).encode()
        return (ids_a, ids_b, bytes_a, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == data else None

    return tokens


def brute_force(docs, whole):
    """Rows in order, and (documents, links) of every pair."""
    per_doc, pairs, holding = [], Counter(), Counter()
    for doc_id, text in docs:
        found = whole(text) if text else None
        if not found:
            per_doc.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b, bytes_a, bytes_b = found
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(bytes_a[i])
            while j > 0 and ends_b[j - 1] > start:
                j -= 1
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(bytes_b[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, at_a, at_b = [], 0, 0
        for cut in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            to_a, to_b = int(np.searchsorted(ends_a, cut)) + 1, int(np.searchsorted(ends_b, cut)) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        per_doc.append((doc_id, len(a), len(b), len(groups), links, sha))
        pairs.update(links)
        holding.update(set(links))
    highest = {}
    for (_, b), n in pairs.items():
        highest[b] = max(highest.get(b, 0), n)
    rows = [
        (d, n_a, n_b, g, len(x), sum(pairs[p] == highest[p[1]] for p in x), sum(pairs[p] for p in x), sha)
        for d, n_a, n_b, g, x, sha in per_doc
    ]
    return rows, {p: (holding[p], n) for p, n in pairs.items()}


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, docs, whole, files):
    frame = spark.createDataFrame([(*d, "b", "p", "n") for d in docs], COLUMNS).repartition(3)
    found, pairs = alignment.align(frame, files)
    rows, expected = brute_force(docs, whole)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(rows, key=key)
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in pairs.collect()} == expected


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "x\ny", "x\n y", "x \n", "\n", "\nx", "\r\nx;\r\n  y", ");\r\n\r\r", "tab\tz\t\t", "　x　　y",
    "a\x1cb \x1c c\x1f", "a​b\xa0c d\x85e", "<s> </s> <unk> <0x41> <|endoftext|>", "▁x", "a▁", "ﬁ ½ é é", "日本語 のテキスト", "😀😀 👩‍👩‍👧",
    "\x00 \x01", "don't we'll 'S 12,345.67", "word" * 300, " " * 100, "ab " * 500, "#" * 200, "Ünïİıß", "﻿x �",
]


def test_odd_texts(spark, whole, files):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "x y"), (3, "a"), (3, "a")]
    check(spark, docs, whole, files)


def test_random_characters(spark, whole, files):
    rng = random.Random(5)
    letters = "ab .,'\n\r\t;1" * 2 + "é日　\xa0\x1c\x85 😀<>{}/*"
    docs = [(i, "".join(rng.choices(letters, k=rng.randrange(60)))) for i in range(600)]
    check(spark, docs, whole, files)


def test_documents(spark, small, whole, files, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 37)
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows], whole, files)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 7, 200, 8192):
        sets = [np.flatnonzero(rng.random(n) < share) for share in (0.0005, 0.01, 0.2, 0.9, 1.0)]
        sets = [x for x in sets if len(x)] + [np.array([n - 1])]
        pairs = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        made = alignment.bitmaps(pairs, np.concatenate(sets), n)
        assert [k for _, k, _ in made] == [len(x) for x in sets]
        data = np.frombuffer(b"".join(x for _, _, x in made), np.uint8)
        row, doc = alignment.documents_of(data, np.cumsum([0, *(len(x) for _, _, x in made)]))
        for i, x in enumerate(sets):
            assert doc[row == i].tolist() == x.tolist()


def test_a_pair_held_by_every_document(spark, files):
    """Planes carry the counts: one pair 1..400 times in 400 documents."""
    docs = spark.createDataFrame([(i, "the " * i + "end") for i in range(400)], "doc_id long, text string")
    found, pairs = alignment.align(docs, files)
    the = pairs.orderBy("n_links", ascending=False).first()
    assert (the.n_docs, the.n_links) == (399, 399 * 400 // 2)
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[10].n_links == 11 and rows[10].count_sum >= 10 * the.n_links
