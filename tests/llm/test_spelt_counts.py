"""Token counts of op7 against a greedy count over the pieces of the model."""

import random

import public_tokenizers
from conftest import rows

from tillmart.llm import queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, starts, inner):
    n, at, own = 1, 0, starts
    if not any(word[:k] in starts for k in range(1, len(word) + 1)):
        own = inner  # after the bare word start
    else:
        n = 0
    while at < len(word):
        for k in range(len(word), at, -1):
            if word[at:k] in own:
                n, at = n + 1, k
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
        own = inner
    return n


def test_small_vocabulary():
    rng = random.Random(4)
    for _ in range(200):
        starts, inner = (
            {"".join(rng.choices("abcñ", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 6))}
            for _ in range(2)
        )
        automaton = token_counts.Automaton(starts, inner, True)
        for _ in range(40):
            word = "".join(rng.choices("abcñ漢", k=rng.randint(1, 9)))
            assert automaton.count(word) == greedy(word, starts, inner), (word, starts, inner)


def test_query_spells_every_word(spark, tmp_path, sf_dir):
    starts, inner = map(set, token_counts.pieces(MODEL))
    texts = ["7 42 x9", "ñandú ça être", "漢字" * 50, "한국어 हिन्दी \U00013000q", None, ""]
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()
    table = list(enumerate([*texts, *(r.text for r in given)]))
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    want = []
    for doc_id, text in table:
        words = [w.decode() for w in (text or "").encode().split()]
        want.append((doc_id, len(words), sum(greedy(w, starts, inner) for w in words), 0))
    assert rows(queries.op7_token_counts(spark, str(tmp_path))) == sorted(want, key=repr)
