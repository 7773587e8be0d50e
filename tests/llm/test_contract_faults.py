"""Cases that once gave wrong results: marks after a dotted I, numerals, repeated vector ids."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidalfed.llm import language, packing, queries, vectors


def test_ids_of_any_text_equal_the_tokenizer(spark):
    draw = random.Random(3)
    letters = "abcİIıΣσςßÅé.,;!'’ \n\t́̇ͅǅﬁⅧ½日本x1 9A\U0001f600­‍&%"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 24)))
             for _ in range(60_000)]
    tokenizer = Tokenizer.from_file(queries.tokenizer())
    words = packing.WordIds(queries.tokenizer())
    chunks = [t.replace("\n", " ").split(" ") for t in texts]
    wanted = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for text, some, want in zip(texts, chunks, wanted):
        got = np.frombuffer(b"".join([words[c] for c in some]), "<u4")
        assert got.tolist() == want.ids, repr(text)


def test_numerals_are_no_letters():
    net = language.train(np.zeros((4, language.WINDOW), np.uint8), np.array([0, 1, 0, 1]),
                         ["a", "b"])
    labels, scores = language.classified(net, ["½ ² 12", "Ⅷ ①", "", None, "x"])
    assert labels[:4] == ["und"] * 4 and scores[:4] == [0.0] * 4 and labels[4] != "und"


def test_language_stage(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "12 ½"), (3, None), (4, "")],
                                 "doc_id long, text string")
    kept = language.in_a_language(docs, None)  # nothing to learn from
    assert [r.doc_id for r in kept.collect()] == [1]
    net = language.train(np.zeros((4, language.WINDOW), np.uint8), np.array([0, 1, 0, 1]),
                         ["a", "b"])
    assert language.in_a_language(docs, net, least=1.1).count() == 0
    assert [r.doc_id for r in language.in_a_language(docs, net, least=0.0).collect()] == [1]


def brute_force(rows):
    usable = [(i, np.array(v) / np.linalg.norm(v), k) for i, v, k in rows]
    links = {n: 0 for n in range(len(rows))}
    low = {i: i for i, _, _ in usable}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, (i, u, k) in enumerate(usable):
        for b in range(a):
            j, w, m = usable[b]
            if k == m and u @ w >= 0.98:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(i), root(j)))
                low[y] = x
    return sorted((i, links[n], root(i)) for n, (i, _, _) in enumerate(usable))


def test_repeated_ids_of_other_labels_do_not_link(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.001], 2), (6, [1.0, 0.01], 1)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, "
                                                           "label int"))
    assert sorted((r.vec_id, r.n_links) for r in got.collect()) == [(1, 0), (1, 1), (6, 1)]


@pytest.mark.parametrize("block", [16, 1024])
def test_thousands_of_links_against_brute_force(spark, block):
    """Hot buckets and pairs around the threshold; recall is 0.99 or more by count."""
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(40, 64))
    rows = []
    for n in range(900):
        centre = centres[0] if n % 3 == 0 else centres[draw.integers(40)]
        noise = draw.normal(size=64) * draw.choice([0.02, 0.08, 0.12])
        rows.append((n, (centre + noise).tolist(), int(n % 2)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id)
                 for r in vectors.near_vectors(frame, block=block).collect())
    want = brute_force(rows)
    found, all_ = sum(g[1] for g in got), sum(w[1] for w in want)
    assert all_ > 5000 and found <= all_ and found >= 0.99 * all_
    assert all(g[1] <= w[1] for g, w in zip(got, want))
