"""Encoder, packing, token files and token counts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import ids, token_file, tokenizer
from conftest import rows

from tillmart.llm import packing, token_counts, token_files
from tillmart.llm.encoder import Encoder
from tillmart.sources.shared import new_folder

BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    "  \n",
    "<|endoftext|> x",
    "<|ENDOFTEXT|>",
    "A<|startoftext|>B",
    "it's I'LL They'Ve",
    "ΑΣ ΑΣ. İıẞ",
    "é É ́x 漢字,kana 한",
    "ÉtÉ, naïve. \x85\xa0　 z",
    "word " * 9000,
]


def docs(spark, given):
    return spark.createDataFrame(given, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_encoder_equals_the_library(most):
    rng = random.Random(1)
    letters = "abcXYZ éÉçß.,!?'012\n\t\x0b\x85Σİ<|>&\U0001f600́"
    texts = [t or "" for t in ODD]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(800)]
    encoder = Encoder(BPE, 2, most)
    for part in (texts[:300], texts[300:]):
        found, n = encoder.encode([t.encode() for t in part])
        ends = np.cumsum(n)
        for text, a, b in zip(part, ends - n, ends, strict=True):
            assert list(found[a:b]) == list(ids(text)), text
    assert list(Encoder(BPE, None).encode([b"a"])[0]) == tokenizer().encode("a").ids


def test_pack_keeps_all_and_pads_little():
    rng = random.Random(2)
    for size in (8, 4096):
        for n in (0, 1, 7, 200):
            lengths = [rng.choice([1, size, 2 * size, rng.randint(1, 3 * size)]) for _ in range(n)]
            found = {}
            for sequence in packing.pack(lengths, size):
                assert 0 < sum(k for *_, k in sequence) <= size
                for doc, at, k in sequence:
                    found.setdefault(doc, []).append((at, k))
            for doc, length in enumerate(lengths):
                at = 0
                for start, k in sorted(found[doc]):
                    assert start == at
                    at += k
                assert at == length
    lengths = [int(rng.lognormvariate(6, 1)) + 1 for _ in range(3000)]
    used = [sum(k for *_, k in s) for s in packing.pack(lengths)]
    padding = sum(4096 - u for u in used if u & (u - 1))
    assert padding < 0.002 * sum(lengths)


def test_first_fit_takes_the_leftmost_bin():
    rng = random.Random(3)
    sizes = [rng.randint(1, 50) for _ in range(300)]
    tree, room = packing.RoomTree(300, 50), [50] * 300
    for s in sizes:
        first = next(i for i, r in enumerate(room) if r >= s)
        room[first] -= s
        assert tree.take(s) == first


@pytest.mark.parametrize("group", [1 << 21, 500])
def test_packed_pieces_hold_every_id(spark, group):
    given = [*enumerate(ODD), (3, "again"), (3, "again"), (None, "no id")]
    frame = docs(spark, given).selectExpr("*", "1 AS start", "text AS offset", "2 AS ids")
    found = packing.packed(frame, BPE, 2, group_tokens=group, with_ids=True).collect()
    assert len({(r.doc_id, r.start, r.sequence_id, r.offset) for r in found}) == len(found)
    by_sequence, by_doc = {}, {}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    for doc_id, text in given:
        if doc_id == 3:
            continue
        whole = [i for _, part, _ in sorted(by_doc[doc_id]) for i in part]
        assert whole == list(ids(text))
        assert {n for *_, n in by_doc[doc_id]} == {len(whole)}
    assert sum(map(len, (p for _, p, _ in by_doc[3]))) == len(ids(ODD[3])) + 2 * len(ids("again"))
    assert packing.packed(frame.limit(0), BPE, 2).count() == 0


def test_token_files_round_trip(spark):
    given = [*enumerate(ODD, 5), (None, "no id")]
    path = new_folder(spark, "t")
    frame = docs(spark, given).selectExpr("*", "1 AS part", "2 AS start")
    token_files.write(frame, path, BPE, 2)
    assert rows(token_files.digests(spark, path)) == sorted(token_file(given), key=repr)
    for r in token_files.read(spark, path).collect():
        assert r.ids == list(ids(dict(given)[r.doc_id]))
    plan = token_files.read(spark, path).where("doc_id = 7")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan


def test_token_files_repeated_ids_and_empty(spark):
    given = [(1, "b"), (1, "a"), (1, "b"), (0, "c")]
    path = new_folder(spark, "t")
    token_files.write(docs(spark, given), path, BPE, 2)
    found = token_files.digests(spark, path).orderBy("start").collect()
    crc = [zlib.crc32(ids(t).tobytes()) for t in "cabb"]
    assert [(r.doc_id, r.ids_crc32) for r in found] == list(zip([0, 1, 1, 1], crc, strict=True))
    path = new_folder(spark, "t")
    token_files.write(docs(spark, []), path, BPE, 2)
    assert token_files.digests(spark, path).count() == 0


def test_counts_equal_word_pieces(spark, sf_dir):
    from tokenizers import Tokenizer, models

    model = public_tokenizers.path("piece_bpe_32k.model")
    starts, inner = token_counts.pieces(model)
    vocabulary = {"[UNK]": 0}
    for piece in (*starts, *("##" + x for x in inner)):
        vocabulary.setdefault(piece, len(vocabulary))
    kind = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**9)
    library = Tokenizer(kind)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    given = list(enumerate([*ODD, *texts, "漢字zz q\U00013000q"]))
    want = []
    for doc_id, text in given:
        words = [b.decode() for b in (text or "").encode().split()]
        found = [library.encode(w, add_special_tokens=False).ids for w in words]
        want.append((doc_id, len(words), sum(map(len, found)), sum(f == [0] for f in found)))
    frame = docs(spark, given).selectExpr("*", "1 AS n_words")
    assert rows(token_counts.token_counts(frame, model)) == sorted(want, key=repr)
    assert token_counts.token_counts(frame.limit(0), model).count() == 0


def test_small_automaton():
    a = token_counts.Automaton(["a", "ab", "abcd"], ["b", "c", "cd", "d", "bcx"])
    assert [a.count(w) for w in ("a", "abc", "abcd", "abcdd", "abcx", "abx", "x")] == [
        1, 2, 1, 2, 0, 0, 0,
    ]
