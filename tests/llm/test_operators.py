"""Each operator on a small table with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from pyspark.sql import functions as F

from riskmart.llm import components, decontamination, fingerprints, jaccard, labelled, language_model, mixing, passages, quality, sharding, suffixes, toxicity
from riskmart.llm.words import crc_of_id, shingle_sets, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, shard int, key string, token string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def text_of(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "ke", "lo", "mi", "zu", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows() -> list[tuple]:
    base, other = text_of(1, 120), text_of(2, 90)
    near = base.split()
    near[40] = "changed"
    texts = [base, " ".join(near), base, other, None, "", "   ", "one", "one", other + " " + text_of(3, 400), text_of(4, 60) + " " + base, "a" * 3000, text_of(5, 8000), base.upper()]
    out = [(k, t, "en", None if k % 5 == 4 else f"s{k % 3}") for k, t in enumerate(texts)]
    return [*out, out[3], (None, text_of(6, 70), "en", "s0"), (3, text_of(7, 70), "en", "s0")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 2, 3, "k", "t") for r in rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_words_and_sets_equal_plain_python():
    texts = [r[1] for r in rows()]
    w = words(pa.array(texts))
    assert np.diff(w.ptr).tolist() == [len(lowered(t)) for t in texts]
    hashes: dict[str, int] = {}
    for word, value in zip([x for t in texts for x in lowered(t)], w.hash.tolist(), strict=True):
        assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)
    _, ptr = shingle_sets(pa.array(texts), 5)
    sizes = [len({tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))}) if (x := lowered(t)) else 0 for t in texts]
    assert np.diff(ptr).tolist() == sizes


def test_fingerprints(spark, docs, empty):
    got = fingerprints.with_next(docs).collect()
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = sorted((r[0] is not None, r[0] or 0, r[1] or "", n[1] or "") for r, n in zip(ordered, ordered[1:] + ordered[:1], strict=True))
    assert sorted((g["doc_id"] is not None, g["doc_id"] or 0, g["text"], g["next_text"]) for g in got) == expected
    assert fingerprints.with_next(empty).count() == 0
    prints = fingerprints.fingerprints(pa.array([text_of(k, 30) for k in range(400)])) & np.uint64(0xFFFF)
    frame = spark.createDataFrame([(k, int(p)) for k, p in enumerate(prints)], "doc_id long, fingerprint long")
    counts = {r["fingerprint"]: r["n_within"] for r in fingerprints.near_counts(frame, frame["doc_id"] % 7 == 0).collect()}
    for k in range(0, 400, 7):
        assert counts[int(prints[k])] == int((np.bitwise_count(prints ^ prints[k]) <= 3).sum())


def test_jaccard_components_equal_brute_force(docs, empty):
    sets = []
    for doc_id, text, *_ in rows():
        x = lowered(text)
        sets.append((doc_id, {tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))} if x else set()))
    label = list(range(len(sets)))
    for _ in sets:
        for i, (_, a) in enumerate(sets):
            for j, (_, b) in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    smallest = {g: min((sets[i][0] for i in range(len(sets)) if label[i] == g and sets[i][0] is not None), default=None) for g in label}
    expected = sorted((str(d), len(s), str(smallest[g])) for (d, s), g in zip(sets, label, strict=True))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.link_components(docs).collect()) == expected
    assert jaccard.link_components(empty).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("operator", [lambda d: jaccard.link_components(d), lambda d: passages.repeated_passages(d)])
def test_a_text_without_an_id_joins_its_near_copies(spark, operator):
    base = text_of(31, 200).split()
    step = lambda k, n: " ".join([*(f"a{j}" for j in range(k)), *base[k : 200 - n], *(f"b{j}" for j in range(n))])
    if operator(spark.createDataFrame([], "doc_id long, text string")).columns[1] == "n_shingles":
        texts = [(1, step(24, 0)), (None, step(0, 0)), (2, step(0, 24))]  # 1 and 2 are apart, both are near the middle one
    else:
        texts = [(1, " ".join(base[:80])), (None, step(0, 0)), (2, " ".join(base[120:]))]
    got = operator(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert [r["class_id" if "class_id" in r else "component_id"] for r in got] == [1, 1, 1]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 180)] + [(7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(links, "src long, dst long")).collect())
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 180)) and len(got) == 121


@pytest.mark.parametrize("shape", ["random", "stars", "empty"])
def test_components_equal_union_find(spark, monkeypatch, shape):
    rng = np.random.default_rng(5)
    links = {
        "random": [(int(a), int(b)) for a, b in rng.integers(-60, 60, (70, 2))] * 2 + [(b, a) for a, b in rng.integers(100, 900, (300, 2)).tolist()],
        "stars": [(0, k) for k in range(1, 30)] + [(k, 50) for k in range(51, 60)] + [(50, 50)],
        "empty": [(3, 3)],
    }[shape]
    owner = {x: x for a, b in links if a != b for x in (a, b)}

    def top(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((top(a), top(b)))
            owner[high] = low
    written = []
    monkeypatch.setattr(components, "stored", lambda rows, write=components.stored: written.append(1) or write(rows))
    got = components.connected_components(spark.createDataFrame(links, "src long, dst long")).collect()
    assert len(got) == len(owner) and {r["node"]: r["component"] for r in got} == {x: top(x) for x in owner}
    assert len(written) == 1 or shape == "random"  # stars, and tables without links, take no round


@pytest.mark.parametrize("most_runs", [suffixes.MOST_RUNS, 1])
def test_repeated_bytes_equal_brute_force(spark, docs, empty, most_runs):
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen: set[bytes] = set()
    expected = []
    for doc_id, text, *_ in ordered:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - suffixes.LENGTH + 1):
            window = raw[k : k + suffixes.LENGTH]
            if window in seen:
                covered[k : k + suffixes.LENGTH] = b"\1" * suffixes.LENGTH
            seen.add(window)
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        expected.append((str(doc_id), len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove_repeats(docs, most_runs=most_runs).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(expected)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)
    assert suffixes.remove_repeats(empty).count() == 0


def test_compact_windows_hold_every_passage_once():
    values = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    segment, low, at, high = passages.compact_windows(values, np.array([0, 120, 200]), 20)
    seen = {}
    for s, l, c, h in zip(segment, low, at, high, strict=True):
        for i in range(l, c + 1):
            for j in range(max(c, i + 19), h + 1):
                assert (i, j) not in seen and values[i : j + 1].min() == values[c]
                seen[i, j] = s
    assert len(seen) == sum(n - 19 - k for n in (120, 80) for k in range(n - 19))


def test_passages(docs, empty):
    got = {}
    for r in passages.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [got[k][0]["class_id"] for k in (0, 1, 2, 10)] == [0] * 4
    assert got[9][0]["class_id"] == 3 and got[9][0]["n_spans"] >= 1
    assert all(got[k][0]["class_id"] == k and got[k][0]["n_spans"] == 0 for k in (4, 5, 6, 7, 8, 12))
    assert passages.repeated_passages(empty).count() == 0


def test_a_passage_in_many_texts_of_one_batch_keeps_its_first_posting():
    passage = text_of(21, 50)
    texts = pa.array([f"{text_of(2000 + k, 2)} {passage} {text_of(4000 + k, 2)}" for k in range(100)])
    _, _, names, _ = passages.sequences(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), texts], ["doc_id", "text"])
    (made,) = passages._postings(passages.HASHES, passages.PASSAGE - passages.WIDTH + 1)(iter([batch]))
    rows = made.to_pylist()
    groups: dict[tuple, set] = {}
    for r in rows:
        groups.setdefault((r["token"], r["salt"]), set()).add(r["node"])
    # as in repeated_passages: what is alone under salt 0 is dropped
    left = {r["node"] for r in rows if r["salt"] > 0 or len(groups[r["token"], r["salt"]]) > 1}
    assert left == set(names.tolist())


def test_minima_outside_the_passages_found_stay_open(spark):
    links = spark.createDataFrame([(1, 2, 0, 60, 100, 160)], passages.SPANS)
    tokens = spark.createDataFrame([(9, 1, 10), (9, 2, 110), (9, 1, 70), (9, 2, 20), (9, 3, 0), (9, 1, 56)], "token long, node long, c int")
    got = {(r["node"], r["c"]): r["component"] for r in passages._open(tokens, links).collect()}
    assert got[1, 10] == got[2, 110]
    assert len({got[1, 10], got[1, 70], got[2, 20], got[3, 0]}) == 4 and got[1, 56] == got[1, 70]
    with_two = {r["c"] for r in passages.in_lists(passages._open(tokens.filter("c IN (70, 20)"), links)).collect()}
    assert with_two == {20, 70}


def near_passages(n: int) -> list[list[str]]:
    """Pairs of passages of 50 to 120 words just similar enough, by brute force over their shingles; every other pair amid text."""
    rng, out = random.Random(17), []
    cut = lambda x: {tuple(x[k : k + passages.WIDTH]) for k in range(len(x) - passages.WIDTH + 1)}
    while len(out) < n:
        amid = len(out) % 2
        one = text_of(rng.randrange(10**6), rng.randint(50, 120 if amid else 54)).split()
        two = list(one)
        for k in range(len(one)):
            at, last = rng.randrange(len(two)), two
            two = [*two[:at], f"x{k}", *two[at + 1 :]]
            if 4 * len(cut(one) & cut(two)) < 3 * len(cut(one) | cut(two)):
                break
        out.append([" ".join([*text_of(3 * len(out) + k, 30 * amid).split(), *x, *text_of(9000 + len(out), (5 * k + 9) * amid).split()[::-1]]) for k, x in enumerate((one, last))])
    return out


def test_near_passages_are_candidates():
    made, least, apart = near_passages(1500), passages.PASSAGE - passages.WIDTH + 1, 0
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([t for pair in made for t in pair])], ["doc_id", "text"])
    value, ptr, names, _ = passages.sequences(batch.column("text"))
    (rows,) = passages._postings(passages.HASHES, least)(iter([batch]))
    tokens: dict[int, set[int]] = {}
    for node, token in zip(rows.column("node").to_pylist(), rows.column("token").to_pylist(), strict=True):
        tokens.setdefault(node, set()).add(token)
    for k in range(0, 3000, 2):
        a, b = (value[ptr[x] : ptr[x + 1]] for x in (k, k + 1))
        apart += len(tokens[int(names[k])] & tokens[int(names[k + 1])]) < passages.AGREE or not passages.passage_pairs(a, b, least)
    assert apart <= 3, apart


def test_windows_of_near_passages_are_alike():
    least, near = passages.PASSAGE - passages.WIDTH + 1, passages.alike(passages.PERCENT)
    for k, pair in enumerate([*near_passages(40), [" ".join(["one two three"] * 30)] * 2]):
        value, ptr, _, _ = passages.sequences(pa.array(pair))
        window = [np.array([0, 0]), np.diff(ptr) // 2, np.diff(ptr) - 1]
        sketch, n = passages.surroundings(value, ptr, np.array([0, 1]), *window, least)
        side = {"n": n, "sketch": np.stack([np.frombuffer(x, np.uint64) for x in sketch])}
        assert near(side, side, np.array([0]), np.array([1]))[0], k
    value, ptr, _, _ = passages.sequences(pa.array([text_of(1, 70), text_of(2, 70)]))
    sketch, n = passages.surroundings(value, ptr, np.array([0, 1]), np.array([0, 0]), np.array([30, 30]), np.diff(ptr) - 1, least)
    side = {"n": n, "sketch": np.stack([np.frombuffer(x, np.uint64) for x in sketch])}
    assert not near(side, side, np.array([0]), np.array([1]))[0]


def edited(text: list[str], at: int, kind: str) -> list[str]:
    return [*text[:at], *(["new"] if kind != "cut" else []), *text[at + (kind != "put") :]]


@pytest.mark.parametrize("around", [0, 30])
@pytest.mark.parametrize("kind", ["change", "put", "cut"])
def test_short_passages_with_an_edit_anywhere_equal_brute_force(kind, around):
    least, n_met = passages.PASSAGE - passages.WIDTH + 1, 0
    for n in (50, 51, 55, 60, 70):
        text = text_of(n, n).split()
        for at in range(n):
            pair = [[*text_of(1, around).split(), *x, *text_of(2, around).split()] for x in (text, edited(text, at, kind))]
            pair[1] = [f"_{w}" if not around <= k < len(pair[1]) - around else w for k, w in enumerate(pair[1])]
            value, ptr, _, _ = passages.sequences(pa.array([" ".join(x) for x in pair]))
            a, b = value[: ptr[1]], value[ptr[1] :]
            x, y = (set(v[around : len(v) - around].tolist()) for v in (a, b))
            got = passages.passage_pairs(a, b, least)
            for s, e, bs, be in got:
                one, two = set(a[s:e].tolist()), set(b[bs:be].tolist())
                assert min(e - s, be - bs) >= least and 4 * len(one & two) >= 3 * len(one | two)
            if min(len(x), len(y)) >= least and 4 * len(x & y) >= 3 * len(x | y):
                n_met += 1
                assert got, (n, at)
    assert n_met > 100


def test_language_model(docs, empty):
    got = language_model.score(docs, crc_of_id("key") % 10 == 0).collect()
    assert len(got) == len(rows()) and {r["n_tokens"] for r in got if r["doc_id"] in (4, 5, 6)} == {1}
    assert all(r["score"] <= 0 and 0 <= r["n_known"] <= r["n_tokens"] for r in got)
    trained = [r for r in got if not r["held_out"]]
    assert sum(r["n_tokens"] for r in trained) == got[0]["train_tokens"]
    assert language_model.score(empty, crc_of_id("key") % 10 == 0).count() == 0


def test_gibbs_keeps_customers_seated():
    count = np.array([0, 1, 2, 5, 40])
    total = [0]
    out = language_model.gibbs(count, lambda d: np.full(len(d), 3.0), lambda d, by: total.__setitem__(0, total[0] + by.sum()), 0.5, np.random.default_rng(3))
    for tables in out:
        assert tables[0] == 0 and tables[1] == 1 and (tables[2:] >= 1).all() and (tables[2:] <= count[2:]).all()


def expected_tables(count: int, mass: float, discount: float) -> float:
    """The mean number of tables of a dish, each of whose tables has the weight `mass`, over all seatings."""
    ways = np.array([1.0])  # of k + 1 tables
    for n in range(1, count):
        k = np.arange(1, n + 1)
        ways = np.append((n - k * discount) * ways, 0) + np.append(0, ways * mass)
        ways /= ways.max()
    return float((ways * np.arange(1, count + 1)).sum() / ways.sum())


@pytest.mark.parametrize("same", [4, 300])
def test_gibbs_seats_frequent_pairs_as_often_as_all_seatings_do(same):
    for count, mass in ((3, 1.0), (60, 1.0), (2000, 2.0)):
        out = language_model.gibbs(np.full(same, count), lambda d: np.full(len(d), mass), lambda d, by: None, 0.75, np.random.default_rng(7), samples=3 if same > 99 else 60)  # noqa: B023
        exact = expected_tables(count, mass, 0.75)
        assert abs(np.mean(out) - exact) < 0.06 * exact, (count, exact, np.mean(out))
    assert language_model.SAMPLES == 3


def test_frequent_words_have_as_many_parent_tables_as_all_seatings_do(monkeypatch):
    monkeypatch.setattr(language_model, "gibbs", None)  # no step per customer
    d, shards, words_ = language_model.PARENT[0], 10, 400
    for count, distinct in ((3, 4000.0), (2000, 4000.0), (300, 500.0)):
        parent = language_model.Parent(np.array([1, count]), shards, distinct)
        tables = parent.tables(np.full(words_, count), np.random.default_rng(1), burn_in=40)
        exact = expected_tables(count, parent.weight(tables.sum() - tables.mean()), d)
        assert abs(tables.mean() - exact) < 0.06 * exact, (count, exact, tables.mean())
    tables = language_model.Parent(np.array([1, 5, 40]), shards, 9.0).tables(np.array([0, 1, 5, 40, 0]), np.random.default_rng(1))
    assert tables[[0, 1, 4]].tolist() == [0, 1, 0] and 1 <= tables[2] <= 5 and 1 <= tables[3] <= 40


def test_an_owner_answers_without_a_step_per_customer(monkeypatch):
    monkeypatch.setattr(language_model, "gibbs", None)
    facts = np.array([[9, 9], [9, 9], [5, 1], [70_000, 1]], np.uint32)
    known = np.diff(np.array([3, 8], np.uint64), prepend=np.uint64(0))
    asked = pa.table({"owner": pa.array([0], pa.int32()), "shard": pa.array([1], pa.int32()), "known": [language_model.pack(known)], "facts": [language_model.pack(facts)]})
    got = {r["shard"]: r for r in language_model._answers(2, 1)((pa.scalar(0),), asked).to_pylist()}
    assert set(got) == {0, 1} and got[0]["totals"][:3] == [18.0, 2.0, 70_001.0]
    roots = language_model.unpack(got[1]["facts"], np.uint32).reshape(5, -1)[4]
    assert 1 <= roots[0] < 100 and roots[1] == 1 and got[0]["totals"][3] == roots.sum()


@pytest.mark.parametrize("few", [16, 40, 10_000])
def test_gibbs_seats_alike_by_numbers_and_by_arrays(monkeypatch, few):
    rng = np.random.default_rng(2)
    count = np.append(rng.integers(0, 30, 400), [90, 200, 3000])

    def seated() -> list[np.ndarray]:
        total = [0.0]
        changed = lambda d, by: total.__setitem__(0, total[0] + float(by.sum()))
        return language_model.gibbs(count, lambda d: np.full(len(d), 1.0 + total[0] / 999), changed, 0.75, np.random.default_rng(3))

    plain_ = seated()
    monkeypatch.setattr(language_model, "MANY", few)
    monkeypatch.setattr(language_model, "LAST", few)
    assert all(np.array_equal(x, y) for x, y in zip(plain_, seated(), strict=True))


def test_mixing(docs, empty):
    got = mixing.mix(docs, flight_size=3).collect()
    assert len(got) == len(rows())
    assert sum(r["size"] for r in got) == sum(len(lowered(r[1])) for r in rows())
    goals = {r["source"]: (r["source_size"], r["target"]) for r in got}
    assert abs(sum(t for _, t in goals.values()) - sum(s for s, _ in goals.values())) < 1e-6
    assert all(t <= 3 * s + 1e-9 for s, t in goals.values()) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs.repartition(5), flight_size=3).collect()))
    assert mixing.mix(empty).count() == 0
    assert mixing.take_mix(docs).columns == docs.columns


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(5)
    size, chance = rng.integers(0, 500, 300), np.full(300, 0.37)
    p = mixing.flight(size, chance, np.arange(300))
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert abs(p.sum() - chance.sum()) < 1e-6 and abs((p * size).sum() - (chance * size).sum()) < 1e-4


def test_sharding(docs, empty):
    table = sharding.lookup_table([f"shard-{k}" for k in range(64)])
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    grown = sharding.lookup_table([f"shard-{k}" for k in range(65)])
    assert np.mean(np.array(table) != np.array(grown)) < 0.08
    got = sharding.assign_shards(docs)
    assert got.count() == len(rows()) and got.columns.count("shard") == 1
    assert all(r["shard"] == table[r["slot"]] for r in got.collect())
    assert sharding.assign_shards(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "b"], 100)


def edit_distance_inside(item: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (a != b)))
        row = now
    return min(row)


def test_decontamination_equals_brute_force(spark, empty):
    rng = random.Random(9)
    items = [(k, text_of(50 + k, 14 + k)) for k in range(6)] + [(6, None), (7, ""), (8, "short")]
    texts = [text_of(80 + k, 60) for k in range(6)] + [None, ""]
    for k in range(12):
        item = list(items[k % 6][1])
        for _ in range(k % 4):
            item[rng.randrange(len(item))] = rng.choice("xyz")
        texts.append(text_of(90 + k, 20) + " " + "".join(item) + " " + text_of(99 + k, 20))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.find_leaks(docs, benchmark, block_bytes=200).collect()}
    normal = lambda t: decontamination.normal(np.frombuffer((t or "").encode(), np.uint8)).tobytes()
    expected = {}
    for d, text in enumerate(texts):
        for i, item in items:
            a = normal(item)
            if len(a) >= decontamination.Q:
                edits = edit_distance_inside(a, normal(text))
                if edits <= min(len(a) * 5 // 100, len(a) // decontamination.Q - 1):
                    expected[d, i] = edits
    assert got == expected and len(expected) >= 6
    assert decontamination.find_leaks(empty, benchmark).count() == 0
    left = {r["doc_id"] for r in decontamination.drop_leaks(docs, benchmark).collect()}
    assert left == set(range(len(texts))) - {d for d, _ in expected}


def test_decontamination_takes_one_block_at_a_time_and_items_without_an_id(spark):
    items = [(None, text_of(61, 20)), (1, text_of(62, 20)), (2, text_of(63, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontamination._blocks(benchmark, 10)
    assert next(blocks) == [(None, items[0][1].encode())] and len(list(blocks)) == 2
    docs = spark.createDataFrame([(7, f"{text_of(64, 9)} {items[0][1]}"), (8, items[2][1])], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()} == {(7, None), (8, 2)}
    assert decontamination.drop_leaks(docs, benchmark).count() == 0


@pytest.mark.parametrize("model", [toxicity, quality])
def test_classifiers_on_edge_cases(spark, docs, empty, model):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    label = "toxic" if model is toxicity else "quality"
    weights = model.learn(docs, labels, label)
    got = model.score(docs, weights).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert model.score(empty, weights).count() == 0


def test_classifiers_learn(spark):
    rng = random.Random(4)
    made = []
    for k in range(400):
        sentences = [text_of(1000 + 10 * k + j, 8) for j in range(5)]
        bad = k % 3 == 0
        if bad:
            sentences[rng.randrange(5)] += " " + rng.choice(["rotter", "rottest", "cad"])
        made.append((k, ". ".join(sentences) + ".", int(bad), int(k % 4 > 0)))
    texts = [(k, t if good else " ".join(w + " " + w for w in t.split())) for k, t, _, good in made]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, g, b) for k, _, b, g in made if k < 300], "doc_id long, quality int, toxic int")
    for model, label, at in ((toxicity, "toxic", 2), (quality, "quality", 3)):
        scores = {r["doc_id"]: r["score"] for r in model.score(docs, model.learn(docs, labels, label)).collect()}
        assert sum((scores[m[0]] >= 0.5) == bool(m[at]) for m in made[300:]) >= 95


def test_a_shard_is_seated_once(monkeypatch):
    spread, shards, samples, seated = np.ones(1 << language_model.SKETCH_BITS, np.int64), 3, 2, []
    plain_seatings = language_model.seatings
    monkeypatch.setattr(language_model, "seatings", lambda shard, number, *rest: seated.append(number) or plain_seatings(shard, number, *rest))
    texts = [text_of(k, 30) for k in range(8)]
    batch = pa.table({"key": pa.array(range(8), pa.int64()), "copy": pa.array([0] * 8, pa.int32()), "text": texts, "held": [k > 5 for k in range(8)]}).to_batches()[0]
    packed = pa.Table.from_batches(language_model._packed(spread, shards, "held")(iter([batch])))
    of = lambda table, column: [(k, table.filter(pa.compute.equal(table.column(column), k))) for k in pa.compute.unique(table.column(column))]
    requests = pa.concat_tables(language_model._requests(spread, shards, samples)((k,), t) for k, t in of(packed, "shard"))
    answers = pa.concat_tables(language_model._answers(shards, samples)((k,), t) for k, t in of(requests, "owner"))
    replies = dict((k.as_py(), t) for k, t in of(answers, "shard"))
    scored = [language_model._scores(shards, samples)((k,), t, replies[k.as_py()]) for k, t in of(packed, "shard")]
    assert len(seated) == len(set(seated)) == len(scored) > 1
    assert {t.column("train_tokens")[0].as_py() for t in scored} == {6 * 31}


def test_a_shard_counts_the_pairs_of_all_its_packs():
    texts = [text_of(k % 5, 40) for k in range(9)] + ["", "again again again"]
    want, packed = Counter(), []
    for low in (0, 4, 8):  # a pack each
        part = texts[low : low + 4]
        made = {"key": pa.array(range(low, low + len(part)), pa.int64()), "copy": pa.array([0] * len(part), pa.int32()), "text": part, "held": [False] * len(part)}
        packed += language_model._packed(np.ones(1 << language_model.SKETCH_BITS, np.int64), 1, "held")(iter(pa.table(made).to_batches()))
        for text in part:
            word, _ = language_model.tokens(pa.array([text]))
            want.update(zip(word.tolist(), [int(language_model.START), *word[:-1].tolist()], strict=True))
    shard = language_model.load(pa.Table.from_batches(packed))
    assert dict(zip(zip(shard.word.tolist(), shard.context.tolist(), strict=True), shard.count.tolist(), strict=True)) == want
    assert (shard.known[shard.word_at] == shard.word).all() and (shard.known[shard.context_at] == shard.context).all()
    tokens_of = np.bincount(shard.doc, minlength=len(texts))[np.argsort(shard.keys)]
    assert tokens_of.tolist() == [len(t.split()) + 1 for t in texts]


def test_near_copies_meet_in_few_lists_at_first(spark, monkeypatch):
    base = text_of(31, 200).split()
    texts = [" ".join([*base[: 5 * k + 20], f"changed{k}", *base[5 * k + 21 :]]) for k in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.link_components(frame).collect()} == {0}

    def sizes(near):
        def run(batches):
            for batch in batches:
                n = np.diff(batch.column("members").offsets.to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array([random.getrandbits(62) for _ in n], pa.int64())], ["a", "b"])

        return run

    monkeypatch.setattr(jaccard, "_forests", sizes)
    made = jaccard._prefix_rows(frame, jaccard.frequency_sketch(frame), 5, 75, jaccard.HOT)
    postings = made.select("node", F.explode("tokens").alias("token")).withColumn("lists", F.lit(1).cast("long"))
    met = jaccard.closest_pairs(postings, made.select("node", "n", "sketch"), jaccard.similar(75)).agg(F.sum("a")).first()[0]
    assert 0 < met <= jaccard.FIRST_TOKENS * len(texts) < postings.count() / 3


def test_marked_rows_hold_all_wanted_ones(spark):
    frame = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") * 7919).alias("doc_id"), F.lit("x").alias("text"))
    for wanted in (frame.filter("doc_id % 30 = 0"), frame.filter("doc_id IS NULL"), frame.filter("false")):
        got = {r["doc_id"] for r in jaccard.marked(frame, wanted, "doc_id").filter("marked").collect()}
        want = {r["doc_id"] for r in wanted.collect()}
        assert want <= got and len(got) <= len(want) + 5


def test_training_holds_the_terms_it_learns_only(spark):
    texts = [(k, text_of(k, 60) + (" awful." if k % 4 == 0 else ""), k % 4 == 0) for k in range(200)] + [(200, "", False)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, y boolean").selectExpr("doc_id", "text", "double(y) y")

    def seen(rows):
        return np.array([sum(len(r[2]) for r in rows), *toxicity.train(rows)])

    whole = labelled.fit(frame, toxicity._features, seen)
    short = labelled.fit(frame, toxicity._features, seen, toxicity._only_telling)
    assert np.array_equal(whole[1:], short[1:]) and np.count_nonzero(short[1:-1]) > 0
    assert 0 < short[0] < whole[0] / 10
