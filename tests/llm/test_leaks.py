import random

import numpy as np

from stemma.llm.leaks import LEAST_TERMS, Passages, Steps, common_run, latent_space, leaked, step_codes, term_weights, windows

WORDS = "amber barrel candle dagger ember falcon garnet hammer island jasper kettle lantern marble needle orchard pebble quarry ribbon saddle timber umbrella velvet walnut yonder zephyr anchor beacon copper drizzle engine feather glacier harvest ivory jungle kernel ladder meadow nectar oyster".split()


def text_of(words, per_cue=6, damage=None, between=None):
    out = []
    for k in range(0, len(words), per_cue):
        line = " ".join(words[k : k + per_cue])
        out.append(f"{len(out) + 1}\n00:00:{len(out):02d},000 --> 00:00:{len(out) + 1:02d},000\n{damage(line) if damage else line}\n")
        if between:
            out.append(f"{len(out) + 1}\n00:01:{len(out):02d},000 --> 00:01:{len(out) + 1:02d},000\n{between}\n")
    return "\n".join(out)


def test_whole_partial_damaged_and_split_passages(spark):
    rng = random.Random(2)
    items = [(i, rng.choices(WORDS, k=40)) for i in range(1, 13)]
    talk = "well you know that I would say so and they go home"
    docs, want = [], set()
    for i, p in items:
        docs += [(i * 100, text_of(p)), (i * 100 + 1, text_of(p[10:24])), (i * 100 + 2, text_of(p, damage=lambda s: s.upper().replace("O", "0").replace("L", "1"))), (i * 100 + 3, text_of(p, between=talk)), (i * 100 + 4, text_of([w for k, w in enumerate(p) if k % 7 != 6]))]
        want |= {(i * 100 + k, i) for k in range(5)}
        docs += [(i * 100 + 5, text_of(p[5:13])), (i * 100 + 6, text_of([w if k % 3 else "other" for k, w in enumerate(p)]))]
    docs += [(k, text_of(talk.split() * 4)) for k in range(50)] + [(60, None), (61, ""), (62, " "), (63, "talk " * 50_000)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int").repartition(3)
    it = spark.createDataFrame([(i, " ".join(p)) for i, p in items] + [(77, None), (78, ""), (79, "too short")], "item_id long, passage string")
    got = {(r.doc_id, r.item_id) for r in leaked(df, it).collect()}
    assert got == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(WORDS[:20]))], "item_id long, passage string")
    assert leaked(docs.limit(0), items).count() == 0
    assert leaked(docs, items.limit(0)).count() == 0
    assert leaked(docs, items).count() == 0


def test_any_number_of_foreign_cues_between(spark):
    p = random.Random(5).choices(WORDS, k=20)
    talk = "\n".join(f"{k}\n00:02:{k % 60:02d},000 --> 00:03:{k % 60:02d},000\nwell you know that I would say so and they go home\n" for k in range(60))
    split = text_of(p[:10], per_cue=5) + "\n" + talk + "\n" + text_of(p[10:], per_cue=5)
    docs = spark.createDataFrame([(1, split), (2, text_of(p[:10]) + "\n" + talk)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(p))], "item_id long, passage string")
    assert [(r.doc_id, r.words) for r in leaked(docs, items).collect()] == [(1, 20)]


def test_replaced_words_and_the_answer_check():
    p = [int(x) for x in np.random.default_rng(3).permutation(40)[:20]]
    weights = np.ones(50)
    steps, doc = Steps(np.array(p), 50, weights), np.array(p)
    run = lambda d, line=None: common_run(step_codes(np.array(d), 50), np.zeros(len(d), int) if line is None else np.array(line), steps)
    assert run(p) == (20, 1.0) and run(p[:9]) == (9, 1.0) and run([45, 46]) == (0, 0.0)
    replaced = doc.copy()
    replaced[[5, 10, 15]] = -1
    assert run(replaced) == (17, 17 / 20)
    assert run(p[:10] + [45] + p[10:]) == (20, 1.0)
    assert run(p[:10] + [45] * 30 + p[10:])[0] == 10  # not within a cue
    assert run(p[:10] + [45] * 3_000 + p[10:], [0] * 10 + [1] * 3_000 + [2] * 10)[0] == 20
    weights[p[5]] = weights[p[10]] = 9.0
    assert common_run(step_codes(replaced, 50), np.zeros(20, int), Steps(doc, 50, weights)) == (17, 17 / 36)


def test_every_run_of_a_passage_keeps_terms_with_weight():
    sequences = [np.arange(12, dtype=np.int32), np.arange(6, 30, dtype=np.int32), np.zeros(15, np.int32)]
    w = term_weights(np.full(30, 90), 100, sequences, 12)
    assert all(len(np.unique(s[lo : lo + 12][w[s[lo : lo + 12]] > 0])) >= min(LEAST_TERMS, len(set(s[lo : lo + 12].tolist()))) for s in sequences for lo in range(len(s) - 11))
    assert (term_weights(np.array([1, 90]), 100, [], 12) > 0).tolist() == [True, False]


def test_latent_space_against_a_whole_decomposition(spark):
    rng = np.random.default_rng(1)
    topics = [rng.permutation(60)[:20] for _ in range(5)]
    docs = [np.array(rng.choice(topics[k % 5], 40), np.int32) for k in range(40)]
    weights = rng.uniform(0.5, 2.0, 60)
    rows = spark.createDataFrame([(k, bytearray(d.tobytes())) for k, d in enumerate(docs)], "doc_id long, ids binary").repartition(3)
    passages = Passages([1], {str(k): k for k in range(60)}, [docs[0]])
    _, row, term, w = windows([*docs, docs[0]], weights)
    a = np.zeros((row.max() + 1, 60))
    np.add.at(a, (row, term), w)
    values = np.linalg.svd(a)[1]
    whole = latent_space(rows, passages, weights, rank=60)
    assert np.allclose(whole.values, values[: len(whole.values)], rtol=1e-3) and np.allclose(whole.basis.T @ whole.basis, np.eye(len(whole.values)), atol=1e-4)
    some = latent_space(rows, passages, weights, rank=30)
    assert np.allclose(some.values[:5], values[:5], rtol=0.05) and 0 < some.residual < 0.4
