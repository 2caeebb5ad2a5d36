"""Columns of any name pass through the stages; different long words have different hashes; small sources meet their targets."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskmart.llm import jaccard, language_model, mixing, sharding
from riskmart.llm.queries import op7_mixing
from riskmart.llm.words import crc_of_id, words


def thue_morse(n: int) -> tuple[str, str]:
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [64, 65, 512, 1024, 4096])
def test_different_long_words_have_different_hashes(size):
    a, b = thue_morse(size)
    hashes = words(pa.array([a, b, f"x {a} y {b} {a}"])).hash.tolist()
    assert hashes[0] != hashes[1] and hashes[3] == hashes[0] == hashes[6] and hashes[5] == hashes[1]


def test_long_words_stay_apart_in_the_operators(spark):
    a, b = thue_morse(1024)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.link_components(docs).collect()} == {1: 1, 2: 2, 3: 1}
    ids = spark.range(1, 60).select(F.col("id").alias("doc_id")).withColumn("held", crc_of_id() % 10 == 0)
    held, learnt = (ids.where(c).first()["doc_id"] for c in ("held", "NOT held"))
    docs = spark.createDataFrame([(learnt, a), (held, b)], "doc_id long, text string")
    known = {r["doc_id"]: r["n_known"] for r in language_model.score(docs, crc_of_id("key") % 10 == 0).collect()}
    assert known == {learnt: 2, held: 1}


ODD = "doc_id long, text string, source string, lang string, __text string, __head long, __id long, __times string, __place int, __slot int, __shard int, row string, key int, id int, body int, digest int, `at` int, owner int, counts int, place int, n int, `a.b` int"


def odd(spark, rows):
    return spark.createDataFrame([(*r, "en", "t", 1, 2, "x", 3, 4, 5, "r", *range(10)) for r in rows], ODD)


def test_stages_keep_columns_of_any_name(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "a"), (2, text + " tail", "b"), (3, None, None), (3, "other text", "a"), (None, text, "b"), (4, "", "b"), (4, "", "b")]
    docs = odd(spark, rows)
    for made in (jaccard.keep_one(docs), mixing.take_mix(docs), sharding.assign_shards(docs)):
        assert [c for c in made.columns if c not in ("slot", "shard")] == docs.columns
        assert {tuple(r)[:3] for r in made.collect()} <= set(rows)
        assert made.where("`a.b` = 9 AND key = 0 AND row = 'r'").count() == made.count() > 0
    kept = sorted(map(repr, (tuple(r)[:3] for r in jaccard.keep_one(docs).collect())))
    assert kept == sorted(map(repr, [rows[0], rows[2], rows[3], rows[4], rows[5]]))
    assert sharding.assign_shards(docs).count() == len(rows)
    empty = docs.limit(0)
    assert [f(empty).count() for f in (jaccard.keep_one, mixing.take_mix, sharding.assign_shards)] == [0, 0, 0]


def plain_targets(sizes: dict) -> dict:
    """Targets by the rule: shares by weight, none above three times its size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1.0 + k % 3 for k, s in enumerate(names)}
    left, full, out = float(sum(sizes.values())), set(), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names if s not in full}
        over = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        full |= over
        if len(full) == len(names):
            return out


def test_mix_meets_plain_targets(spark, sf_dir, duck):
    texts = duck.sql("SELECT doc_id, coalesce(text, ''), source FROM documents").fetchall()
    size = {i: int(np.diff(words(pa.array([t])).ptr)[0]) for i, t, _ in texts}
    of = {}
    for i, _, s in texts:
        of[s] = of.get(s, 0) + size[i]
    want = plain_targets(of)
    taken, largest = dict.fromkeys(of, 0), dict.fromkeys(of, 0)
    source = {i: s for i, _, s in texts}
    for r in op7_mixing(spark, sf_dir).collect():
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == of[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    print({s: round(taken[s] / want[s] - 1, 4) for s in of})
    for s in of:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s], (s, taken[s], want[s], largest[s])


def test_a_spanning_forest_joins_what_the_edges_join():
    rng = np.random.default_rng(5)
    for size, most in ((1, 0), (12, 6), (40, 30), (60, 400)):
        ends = rng.integers(0, size, (2, most))
        ends = ends[:, ends[0] != ends[1]]
        apart = rng.integers(0, 4, ends.shape[1])

        def trees(edges, size=size):
            tree = list(range(size))
            for a, b in edges:
                low, high = sorted((tree[a], tree[b]))
                tree = [low if t == high else t for t in tree]
            return tree

        chosen = jaccard.spanning_forest(ends[0], ends[1], apart)
        assert trees(ends[:, chosen].T) == trees(ends.T)
        assert len(chosen) == size - len(set(trees(ends.T)))
        for weight in range(4):  # a forest of least weight has as many edges up to each weight as those edges allow
            light = ends[:, apart <= weight]
            assert (apart[chosen] <= weight).sum() == size - len(set(trees(light.T)))


@pytest.mark.parametrize("hot", [jaccard.HOT, 0])
def test_links_of_a_large_near_group_do_not_depend_on_lists(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "LIST", 4)
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(70):  # copies with one to three words changed: some are too far from all others
        text = list(base)
        for at in rng.choice(60, rng.integers(1, 4), replace=False):
            text[at] = f"x{k}"
        texts.append(text)
    texts += [[f"y{k}-{j}" for j in range(50)] + base[:12] for k in range(20)]  # a passage that different texts share
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link_components(docs, hot=hot).collect()}
    assert [got[k] for k in range(len(texts))] == label
    assert len(set(label)) > 21
